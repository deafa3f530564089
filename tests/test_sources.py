import json

import pytest
from pyspark.sql import functions as F

from strataforge.operators import dimensions, figures, lookup
from strataforge.sources import models, readers, sinks
from strataforge.streaming import ingest


def test_json_arrays(spark, tmp_path):
    for k, part in enumerate([[{"paper_id": "a", "deposit_type": "VMS"}, {"paper_id": "b"}], [{"paper_id": "c"}]]):
        (tmp_path / f"results_{k:06d}.json").write_text(json.dumps(part))
    df = readers.read_records(spark, f"{tmp_path}/results_*.json")
    assert [(r["_ord"], r["paper_id"]) for r in df.orderBy("_ord").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    raw = [r["raw"] for r in readers.read_raw_records(spark, f"{tmp_path}/results_000001.json").collect()]
    assert json.loads(raw[0]) == {"paper_id": "c"}
    sinks.write_json_array(df.select("_ord", "paper_id"), f"{tmp_path}/out")
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert json.loads(text) == [{"paper_id": "a"}, {"paper_id": "b"}, {"paper_id": "c"}]


def test_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert sorted(r["a"] for r in readers.read_lines(spark, str(tmp_path / "x.jsonl"), "a int").collect()) == [1, 2]
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        readers.read_lines(spark, str(tmp_path / "x.jsonl"), "a int", strict=True).collect()
    sinks.write_lines(spark.range(2), str(tmp_path / "o"))
    sinks.write_lines(spark.range(3), str(tmp_path / "o"), append=True)
    assert spark.read.json(str(tmp_path / "o")).count() == 5
    sinks.write_report(spark.range(1), str(tmp_path / "r"))
    sinks.write_parquet(spark.range(1), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1


def test_csv_encoding(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes("site_name,latitude\nMina Peñón,1.5\n".encode("latin-1"))
    assert readers.read_csv(spark, str(tmp_path / "m.csv"), "site_name string, latitude string").first()["site_name"] == "Mina Peñón"


def test_markdown_and_blocks(spark, tmp_path):
    (tmp_path / "c/p 1/auto").mkdir(parents=True)
    (tmp_path / "e").mkdir()
    (tmp_path / "c/p 1/auto/p 1.md").write_text("plain")
    (tmp_path / "c/p 1/auto/q.md").write_text("plain q")
    (tmp_path / "c/p 1/auto/p 1_layout.md").write_text("side")
    (tmp_path / "e/q.md").write_text("better")
    got = {r["paper_id"]: r["text"] for r in readers.read_markdown(spark, str(tmp_path / "c"), str(tmp_path / "e")).collect()}
    assert got == {"p 1": "plain", "q": "better"}
    (tmp_path / "c/p 1/auto/q_content_list.json").write_text(json.dumps([{"type": "text"}, {"type": "image", "img_path": "images/a.jpg"}, {"type": "table", "img_path": ""}]))
    blocks = readers.read_blocks(spark, str(tmp_path / "c"))
    assert [r["uid"] for r in blocks.collect()] == ["q::1::a.jpg"]
    none = spark.createDataFrame([], "image_path string")
    assert readers.read_blocks(spark, str(tmp_path / "c"), present=none).count() == 0
    assert readers.not_done(blocks, blocks.select("uid"), "uid").count() == 0


def test_dimension(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"ord":0,"name":"a","lat":1}\n{"ord":1,"name":"b","lat":2}\n{"ord":2,"name":"a","lat":3}\n')
    rows = readers.read_dimension(spark, str(tmp_path / "d.jsonl"), "ord int, name string, lat double")
    assert {(r["ord"], r["name"], r["lat"]) for r in rows.collect()} == {(0, "a", 3.0), (1, "b", 2.0)}


def test_manifest(spark, tmp_path):
    path, now = str(tmp_path / "m"), sinks.prompt_hash("prompt")
    assert len(now) == 16 and sinks.done_ids(spark, path, now).count() == 0
    sinks.add_done(spark.createDataFrame([("a",)], "paper_id string"), path, now)
    sinks.add_done(spark.createDataFrame([("b",)], "paper_id string"), path, "other")
    assert [r[0] for r in sinks.done_ids(spark, path, now).collect()] == ["a"]
    for k, text in enumerate(['["x", "y"]', json.dumps({"prompt_hash": now, "ids": ["z"]})]):
        (tmp_path / f"old{k}.json").write_text(text)
        sinks.upgrade_manifest(spark, str(tmp_path / f"old{k}.json"), path, now)
    assert {r[0] for r in sinks.done_ids(spark, path, now).collect()} == {"a", "x", "y", "z"}


def test_files_a_record(spark, tmp_path):
    df = spark.createDataFrame([("../a/b", "one\ntwo"), ("c", "three")], "paper_id string, text string")
    sinks.write_per_record(df, str(tmp_path / "o"))
    assert {p.parent.name: p.read_text() for p in (tmp_path / "o").glob("name=*/part-*")} == {"name=a_b": "one\ntwo\0", "name=c": "three\0"}
    assert sinks.safe_path("/out", "x/../y") == "/out/x_y.json" or sinks.safe_path("/out", "x/../y").startswith("/out/")
    with pytest.raises(ValueError):
        sinks.safe_path("/out", "..", "..")


def test_models(spark):
    papers = spark.createDataFrame([("a", "text # References x"), ("b", "other")], "paper_id string, text string")

    def client(prompt):
        if "other" in prompt:
            raise ValueError("down")
        return '```json\n{"paper_id": "wrong", "deposit_type": "VMS"}\n```', 5, 2

    got = {r["paper_id"]: r for r in models.extract(papers, "do", "paper_id string, deposit_type string", client, wait=0.0).collect()}
    assert got["a"]["extracted"]["deposit_type"] == "VMS" and got["a"]["tokens"]["input"] == 5 and "down" in got["b"]["error"]
    def no(prompt):
        if "other" in prompt:
            raise OSError("net")
        return "No.", 1, 1

    said = {r["paper_id"]: r["wanted"] for r in models.prescreen(papers, "ok?", no, wait=0.0).collect()}
    assert said == {"a": False, "b": True}  # fails open
    assert models.answers(papers, "text").where("answer IS NOT NULL").count() == 2
    place = models.extract_coordinates(papers, "?", lambda p: ('x {"latitude": 1, "longitude": 2} y', 1, 1)).first()
    assert (place["latitude"], place["longitude"]) == (1, 2)


def test_reviews_and_questions(spark):
    recs = spark.createDataFrame([("a", "VMS", 0.9, "mineral_deposit"), ("b", "VMS", 0.5, "mineral_deposit"), ("c", "VMS", 0.9, "energy"), ("d", "VMS", 0.9, "mineral_deposit")], "paper_id string, deposit_type string, deposit_type_conf double, deposit_class string")
    texts = spark.createDataFrame([("a", "t"), ("b", "t"), ("c", "t")], "paper_id string, text string")
    got = {r["paper_id"]: (r["skip"], r["result"] and r["result"]["consistent"]) for r in models.review_types(recs, texts, "?", lambda p: ('{"consistent": true}', 1, 1)).collect()}
    assert got == {"a": (None, True), "b": ("low_confidence", None), "c": ("not_deposit", None), "d": ("no_text", None)}
    same = {r["paper_id"]: r["consistent"] for r in models.compare_abstracts(recs, texts, "?", lambda p: ('{"deposit_type": "SMS"}', 1, 1)).collect()}
    assert same == {"a": True, "b": True, "c": True}
    figs = spark.createDataFrame([("p", "x.jpg", "c", "a long enough ground truth"), ("p", "y.jpg", "c", "short")], "paper_id string, image_path string, caption string, full_groundtruth string")
    qs = models.figure_questions(figs, "ask", lambda p: ('[{"question": "Where [A] lies?", "answer": "North"}]', 1, 1))
    assert [r["answer"] for r in qs.collect()] == ["North"]
    assert models.blind_test(qs, lambda p: ("it is north", 1, 1)).first()["guessed"]
    blocks = spark.createDataFrame([("u", "image", "x.jpg")], "uid string, task string, image_path string")
    assert models.read_images(blocks, lambda p: ("", 1, 1)).first()["status"] == "empty"
    names = spark.createDataFrame([("Andes (南)",), ("Nowhere",)], "name string")
    assert [tuple(r) for r in models.geocode(names, lambda n: (1, 2) if n == "Andes" else None, 0.0).collect()] == [("Andes (南)", 1.0, 2.0)]
    pts = spark.createDataFrame([(1.001, 2.0), (1.002, 2.0)], "lat double, lon double")
    assert [r["country"] for r in models.reverse_geocode(pts, lambda a, b: "X", 0.0).collect()] == ["X"]
    assert figures.is_spatial("q") is not None


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"uid":"1","ts":"2024-01-01T00:00:00"}\n{"uid":"1","ts":"2024-01-01T00:01:00"}\n')
    (tmp_path / "in/b.json").write_text('{"uid":"2","ts":"2024-01-01T00:02:00"}\n{"uid":"1","ts":"2024-01-01T00:02:30"}\n')
    stream = ingest.result_stream(spark, str(tmp_path / "in"), "uid string, ts timestamp", 1)
    ingest.append_json(ingest.without_repeats(stream), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["uid"] for r in spark.read.json(str(tmp_path / "out")).collect()) == ["1", "2"]
    (tmp_path / "in/c.json").write_text('{"uid":"3","ts":"2024-01-01T00:03:00"}\n')
    ingest.append_json(ingest.without_repeats(ingest.result_stream(spark, str(tmp_path / "in"), "uid string, ts timestamp", 1)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 3  # goes on where it stopped


def test_guarded_batches(spark, tmp_path):
    schema = "paper_id string, coordinates struct<latitude:double,longitude:double>, deposit_scale struct<tonnage:struct<value:double>,grade:map<string,double>>"
    (tmp_path / "in").mkdir()
    for k, lat in enumerate([10.0, 99.0]):
        (tmp_path / f"in/{k}.json").write_text(json.dumps({"paper_id": str(k), "coordinates": {"latitude": lat, "longitude": 1.0}}))
    stream = ingest.result_stream(spark, str(tmp_path / "in"), schema, 1)
    ingest.guarded_append(stream, str(tmp_path / "out"), str(tmp_path / "ck"), {"coordinates": 0.5}).awaitTermination()
    assert [r["paper_id"] for r in spark.read.parquet(str(tmp_path / "out/accepted")).collect()] == ["0"]
    assert [r["paper_id"] for r in spark.read.parquet(str(tmp_path / "out/_stopped/batch=*")).collect()] == ["1"]


def test_windows(spark, tmp_path):
    spark.range(4).select(F.timestamp_seconds(F.col("id") * 50_000).alias("ts"), F.lit("a").alias("k")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "in"))
    q = ingest.windowed_counts(stream, "ts", "k").writeStream.format("memory").queryName("w").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sum(r["n"] for r in spark.sql("SELECT * FROM w").collect()) == 4


def test_polygons_of_a_file(spark, tmp_path):
    square = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]]
    far = [[[10, 10], [12, 10], [12, 12], [10, 10]]]
    features = [
        {"properties": {"name": "Aland"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"properties": {"name": "Bland", "pop": 3}, "geometry": {"type": "MultiPolygon", "coordinates": [far, square]}},
        {"properties": {"name": "Point"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"properties": {"name": None}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"properties": {"name": "Empty"}, "geometry": None},
    ]
    (tmp_path / "land.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = readers.read_polygons(spark, str(tmp_path / "land.json"), aliases={"Bland": "Republic of B"})
    assert sorted((r["ord"], r["country"], len(r["ring"])) for r in got.collect()) == [(0, "Aland", 5), (1, "Republic of B", 4), (1, "Republic of B", 5)]
    points = spark.createDataFrame([(1, 3.0, 1.0), (2, 10.5, 11.5), (3, 50.0, 50.0)], "_ord long, y double, x double")
    hits = lookup.containing_polygon(points, F.col("y"), F.col("x"), got)
    assert {(r["_ord"], r["country"]) for r in hits.collect()} == {(1, "Aland"), (2, "Republic of B")}


def test_tables_by_name(spark, tmp_path):
    (tmp_path / "belts.json").write_text(json.dumps({"Zed belt": {"lat": 1, "lon": 2.5}, "Alpha": {"lat": -3.0, "lon": 4, "more": "x"}}))
    rows = readers.read_named(spark, str(tmp_path / "belts.json"), "lat: double, lon: double")
    assert [tuple(r) for r in rows.orderBy("ord").collect()] == [(0, "Zed belt", 1.0, 2.5), (1, "Alpha", -3.0, 4.0)]
    rows.write.json(str(tmp_path / "lines"))
    assert {r["name"] for r in dimensions.from_file(spark, str(tmp_path / "lines"), "belts").collect()} == {"Zed belt", "Alpha"}


def test_chunks_are_merged_in_order(spark, tmp_path):
    """Chunks written in any order are read in the order of their names."""
    for k in (2, 0, 1):
        (tmp_path / f"part_{k:03d}.json").write_text(json.dumps([{"paper_id": f"p{k}{j}"} for j in range(2)]))
    rows = readers.read_records(spark, f"{tmp_path}/part_*.json").orderBy("_ord").collect()
    assert [r["paper_id"] for r in rows] == ["p00", "p01", "p10", "p11", "p20", "p21"]
