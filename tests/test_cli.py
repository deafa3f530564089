import json

from strataforge import cli
from strataforge.operators import dimensions


def write(tmp_path, rows):
    (tmp_path / "in.json").write_text(json.dumps(rows))
    return str(tmp_path / "in.json"), str(tmp_path / "out")


def lines(path):
    return [json.loads(x) for p in sorted(path.rglob("part-*.json")) for x in p.read_text().splitlines()]


def test_process(spark, tmp_path):
    rows = [{"paper_id": "a(1)", "x": 1, "_gate_status": "warn"}, {"paper_id": "a", "x": 1, "_gate_status": "pass"}, {"paper_id": "b", "x": None, "_gate_status": "fail"}, {"paper_id": "c"}]
    source, out = write(tmp_path, rows)
    assert cli.process(spark, source, out) == 0
    assert lines(tmp_path / "out/triage_stats") == [{"input": 3, "trusted": 2, "review": 0, "quarantine": 1, "output": 3}]
    assert lines(tmp_path / "out/duplicate_groups")[0]["removed"] == ["a(1)"]
    assert {p.parent.name for p in (tmp_path / "out/records").rglob("part-*")} == {"bucket=trusted", "bucket=quarantine"}


def test_postprocess_and_others(spark, tmp_path):
    rows = [{"paper_id": "the bushveld complex", "countries": ["South Africa"], "deposit_type": "PGE-REEF", "deposit_type_conf": 0.9, "metallogenic_belt": "Bushveld", "structural_controls": ["fault"]}, {"paper_id": "x", "coordinates": {"latitude": 99.0, "longitude": 1.0}}]
    source, out = write(tmp_path, rows)
    assert cli.postprocess(spark, source, out) == 0
    assert lines(tmp_path / "out/coverage")[0]["total"] == 2
    assert {r["_provenance"]["coordinates_source"] for r in lines(tmp_path / "out/records")} <= {"llm_extracted", "mrds_match", "none"}
    assert cli.monitor_batch(spark, source, out) == 1
    assert cli.validate_places(spark, source, out) == 0 and cli.gate_records(spark, source, out) == 0
    assert cli.questions(spark, source, out) == 0 and len(lines(tmp_path / "out/qa")) == 2
    (tmp_path / "d.jsonl").write_text('{"ord":0,"name":"Bushveld","lat":1,"lon":2,"country":"South Africa","type":"PGE-REEF"}\n')
    assert cli.evaluate(spark, source, out, str(tmp_path / "d.jsonl")) == 0
    assert lines(tmp_path / "out/regression")[0]["status"] == "PASS"


def test_survey(spark, tmp_path):
    (tmp_path / "s.csv").write_text("site_name,latitude,longitude,country,dep_type,commod1,dev_stat\nA,1,2,X,,Cu,Producer\nB,1,2,X,,Cu,Prospect\n")
    assert cli.survey(spark, str(tmp_path / "s.csv"), str(tmp_path / "o")) == 0
    assert [r["name"] for r in lines(tmp_path / "o/deposits")] == ["A"]


def test_dimensions(spark, tmp_path):
    assert dimensions.centroids(spark).count() == 97 and dimensions.trusted(spark).count() == 78
    assert dimensions.curated(spark).count() == 36 and dimensions.alias_belts(spark).count() == 49
    dimensions.append(dimensions.alias_belts(spark).select("ord", "name", "lat", "lon").limit(2), str(tmp_path / "b"))
    assert dimensions.from_file(spark, str(tmp_path / "b"), "belts").count() == 2
