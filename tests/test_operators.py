import pytest
from pyspark.sql import functions as F

from strataforge.operators import dedup, enrich, figures, gate, lookup, monitor, qa, records, reports, review, route, score, validate
from strataforge.operators.fixed import FAMILIES, PROVINCE_LEVEL, SITE_LEVEL

PAPER = "_ord long, paper_id string, metallogenic_belt string, tectonic_setting string, deposit_type_evidence string, countries array<string>, coordinates " + records.COORDINATES


def papers(spark, *rows):
    return spark.createDataFrame([(k, r.get("id", f"p{k}"), r.get("belt"), r.get("tectonic"), r.get("evidence"), r.get("countries"), r.get("place")) for k, r in enumerate(rows)], PAPER)


def place(lat, lon, confidence=0.7, precision="x", method="model"):
    return (lat, lon, precision, "s", confidence, method, None)


def coords(df):
    return {r["_ord"]: r["coordinates"] for r in df.collect()}


class TestDedup:
    def rows(self, spark):
        data = [("2303(1)", "a"), ("2303", "a"), ("2304", "a"), ("x(1)", "b"), ("x(2)", "b"), ("y", "c")]
        return spark.createDataFrame([(k, i, c) for k, (i, c) in enumerate(data)], "_ord long, paper_id string, content string")

    def test_keeper(self, spark):
        marked = dedup.mark_duplicates(self.rows(spark), dedup.content_hash(self.rows(spark)))
        assert sorted(r["paper_id"] for r in dedup.unique_rows(marked).collect()) == ["2303", "x(1)", "y"]
        groups = {r["kept"]: (r["removed"], r["count"]) for r in dedup.duplicate_groups(marked).collect()}
        assert groups == {"2303": (["2303(1)", "2304"], 3), "x(1)": (["x(2)"], 2)}
        assert tuple(dedup.dedup_stats(marked).first()) == (6, 3, 3, 2)

    def test_raw(self, spark):
        df = spark.createDataFrame([(0, "p", '{"a":1,"b":[2]}'), (1, "q", '{"b":[2],"a":1}'), (2, "r", '{"a":1,"b":[2],"c":null}')], "_ord long, paper_id string, raw string")
        assert dedup.unique_rows(dedup.mark_duplicates(df, dedup.raw_content_hash("raw"))).count() == 2

    def test_first(self, spark):
        df = spark.createDataFrame([(1, None, "b"), (0, None, "a"), (2, "x", "c"), (3, "", "d")], "_ord long, paper_id string, v string")
        assert {r["v"] for r in dedup.keep_first_by_id(df).collect()} == {"a", "c"}
        assert {r["v"] for r in dedup.first_by_key(df, ["paper_id"], ["_ord"]).collect()} == {"a", "c", "d"}
        assert dedup.duplicates_removed(df).first()[0] == 2


class TestGate:
    COLUMNS = "_ord long, paper_id string, deposit_class string, deposit_type string, deposit_type_conf string, coord_lat string, coord_lon string, ages_ma array<string>, host_rocks array<string>, metallogenic_belt string"

    @pytest.mark.parametrize(
        ("row", "flags", "status"),
        [
            (("p", None, None, None, None, None, None, None, None), [], "pass"),
            ((" ", "odd", None, None, "abc", None, None, None, None), ["FAIL:no_paper_id"], "fail"),
            (("p", "odd", None, None, None, None, None, None, None), ["WARN:unknown_deposit_class=odd"], "warn"),
            (("p", None, None, None, "91", "-181", None, None, None), ["FAIL:lat_out_of_range=91.0", "FAIL:lon_out_of_range=-181.0"], "fail"),
            (("p", None, None, None, "abc", "NaN", None, None, None), ["FAIL:lat_not_numeric=abc", "FAIL:lon_out_of_range=NaN"], "fail"),
            (("p", None, None, None, "0", "0", ["10", "5000", "x"], None, None), ["WARN:age_out_of_range=5000.0"], "warn"),
            (("p", None, None, None, None, None, ["x", "5000"], None, None), ["WARN:age_not_numeric=x"], "warn"),
            (("p", None, "SKARN", "0.4", None, None, None, ["marble"], None), ["FLAG:low_confidence"], "warn"),
            (("p", None, None, "0.4", None, None, None, None, None), [], "pass"),
            (("p", None, "SKARN", "1.2", None, None, None, [], "null"), ["WARN:conf_out_of_range=1.2", "FLAG:deposit_type_but_no_details"], "warn"),
            (("p", None, "SKARN", "no", None, None, ["1"], None, None), [], "pass"),
        ],
    )
    def test_rules(self, spark, row, flags, status):
        df = spark.createDataFrame([(0, *row)], self.COLUMNS)
        got = gate.gate(df).first()
        assert (got["_gate_flags"], got["_gate_status"]) == (flags, status)

    def test_report(self, spark):
        df = spark.createDataFrame([("pass", []), ("fail", ["FAIL:a"]), ("warn", ["FLAG:b", "WARN:c"]), ("warn", ["FLAG:b"])], "_gate_status string, _gate_flags array<string>")
        assert tuple(gate.gate_report(df).first()) == (4, 1, 2, 1, 0.25)
        assert [tuple(r) for r in gate.flag_histogram(df).collect()] == [("FLAG:b", 2), ("FAIL:a", 1), ("WARN:c", 1)]
        assert gate.gate_report(df.limit(0)).first()["pass_rate"] == 0

    def test_contract(self):
        gate.check_contract(["a", "b"], ["a"])
        with pytest.raises(ValueError):
            gate.check_contract(["a"], ["a", "b"])
        with pytest.raises(ValueError):
            gate.check_contract(["a", "z"], ["a"], ["z"])


class TestRoute:
    def test_buckets(self, spark):
        df = spark.createDataFrame([("1", "pass", None), ("2", "warn", None), ("3", "fail", None), ("4", "weird", None), ("5", None, None), ("6", "fail", "pass")], "paper_id string, _gate_status string, _gate_result string")
        got = route.triage(df)
        assert {r["paper_id"]: r["bucket"] for r in got.collect()} == {"1": "trusted", "2": "review", "3": "quarantine", "4": "review", "5": "trusted", "6": "trusted"}
        assert got.columns == ["paper_id", "bucket"] and tuple(route.triage_stats(got).first()) == (6, 3, 2, 1, 6)
        assert {r["bucket"] for r in route.triage(df.drop("_gate_result"), compat=True).collect()} == {"trusted"}
        assert route.split_accepting_warnings(df).where("bucket = 'trusted'").count() == 4

    @pytest.mark.parametrize(("kept", "gone", "ok", "missing", "extra"), [(["a", "b"], ["c"], True, [], []), (["a"], ["c"], False, ["b"], []), (["a", "b", "z"], ["c"], False, [], ["z"])])
    def test_reconcile(self, spark, kept, gone, ok, missing, extra):
        ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "paper_id string")
        row = route.reconcile(ids(["a", "b", "c"]), ids(kept).withColumn("bucket", F.lit("trusted")), ids(gone))
        got = row.first()
        assert (got["reconciled"], got["missing"], got["extra"], got["deduped"]) == (ok, missing, extra, 1)
        assert route.exit_code(row) == (0 if ok else 1)

    def test_property(self, spark):
        """Dedup and triage never lose a record."""
        df = spark.range(300).select(F.col("id").alias("_ord"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("paper_id"), (F.col("id") % 37).cast("string").alias("c"), F.element_at(F.array(*map(F.lit, ("pass", "warn", "fail", "odd"))), (F.col("id") % 4 + 1).cast("int")).alias("_gate_status"))
        for shuffled in (df, df.repartition(7, "c")):
            marked = dedup.mark_duplicates(shuffled, F.md5("c"))
            got = route.reconcile(shuffled, route.triage(dedup.unique_rows(marked)), dedup.removed_rows(marked)).first()
            assert got["reconciled"] and got["rows_reconciled"] and got["deduped"] == 300 - 37


class TestRecords:
    def test_unwrap_and_legacy(self, spark):
        df = spark.read.schema(records.ENVELOPE_SCHEMA).json(spark.sparkContext.parallelize(['{"paper_id":"p1","extracted":{"deposit_type":"VMS","coordinates":{"latitude":1.5},"ages":[{"age_ma":10}],"minerals":{"ore_minerals":["gold"]},"commodities":{"primary":["Au"],"byproduct":["Ag"]}}}']))
        row = records.with_legacy(records.unwrap(df)).first()
        assert (row["paper_id"], row["coord_lat"], row["ages_ma"], row["minerals_mentioned"], row["commodities"]) == ("p1", "1.5", [10.0], ["gold"], ["Au", "Ag"])

    def test_geochemistry(self, spark):
        kind = "struct<trace_elements:struct<enriched:array<string>,depleted:array<string>>,isotopes:map<string,string>,fluid_inclusion:map<string,string>,citation:string>"
        df = spark.createDataFrame([(((["Au"], []), {}, {}, None),), ((None, {}, {}, "c"),) and (((None, None), {}, {}, "c"),), ((None, {"d": "1"}, None, None),), (None,)], f"geochemistry {kind}")
        assert [r["geochemistry"] is not None for r in records.prune_geochemistry(df).collect()] == [True, False, True, False]
        assert records.pruned_count(df).first()[0] == 1

    def test_ordinal(self, spark):
        df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(9)
        assert records.with_ordinal(df, "v").where("v <> _ord").count() == 0


class TestLookup:
    BELTS = [(0, "Jiaodong", 37.0, 120.0), (1, "Jiaodong–North", 38.0, 121.0), (2, "Andes", -20.0, -70.0), (3, "", 0.0, 0.0)]

    def belts(self, spark):
        return spark.createDataFrame(self.BELTS, "ord int, name string, lat double, lon double")

    def test_first_belt(self, spark):
        df = papers(spark, {"belt": "the jiaodong-north belt"}, {"tectonic": "Andes arc"}, {"belt": "elsewhere"}, {"belt": "Andes", "place": place(1.0, 2.0)})
        got = coords(enrich.tier_belt(df, self.belts(spark)))
        assert got[0]["latitude"] == 37 and got[0]["confidence"] == 0.55 and got[1]["longitude"] == -70 and got[2] is None
        assert got[3]["latitude"] == 1  # never overwritten

    def test_either_way(self, spark):
        df = papers(spark, {"belt": "ANDES"}, {"belt": "Central Andes"}, {"belt": "And"}, {"belt": ""}, {"belt": None})
        got = coords(enrich.tier_belt_either(df, self.belts(spark)))
        assert [got[k] and got[k]["confidence"] for k in range(5)] == [0.6, 0.5, 0.5, None, None]

    def test_alias_longest(self, spark):
        dim = spark.createDataFrame([(0, "Yilgarn", -30.0, 120.0, "Australia", ["Yilgarn Craton", "WA"]), (1, "Kalgoorlie in the Yilgarn", -31.0, 121.0, "Australia", [])], "ord int, name string, lat double, lon double, country string, alias array<string>")
        df = papers(spark, {"belt": "Yilgarn  Craton"}, {"belt": "near Kalgoorlie in the Yilgarn craton"}, {"belt": "none"})
        got = coords(enrich.tier_alias(df, dim))
        assert (got[0]["confidence"], got[0]["matched_token"]) == (0.75, "Yilgarn Craton") and got[1]["latitude"] == -31 and got[2] is None

    def test_centroid_and_famous(self, spark):
        centroids = spark.createDataFrame([("Chile", -30.0, -71.0), ("Peru", -10.0, -75.0)], "country string, lat double, lon double")
        df = papers(spark, {"countries": ["Nowhere", "Peru", "Chile"]}, {"countries": []}, {"countries": None})
        got = coords(enrich.tier_centroid(df, centroids))
        assert got[0]["latitude"] == -10 and got[0]["confidence"] == 0.3 and got[1] is None and got[2] is None
        famous = spark.createDataFrame([(0, "Bingham", 40.0, -112.0, "USA"), (1, "Grasberg", -4.0, 137.0, "Indonesia")], "ord int, name string, lat double, lon double, country string")
        df = papers(spark, {"id": "bingham_2001", "countries": ["USA"]}, {"id": "bingham", "countries": ["Peru"]}, {"belt": "Grasberg district"})
        got = coords(enrich.tier_famous(df, famous))
        assert got[0]["confidence"] == 0.95 and got[1] is None and got[2]["latitude"] == -4

    def test_phrases(self, spark):
        dim = spark.createDataFrame([(0, "Bushveld Complex", -25.0, 29.0, "South Africa"), (1, "Cadia Ridgeway", -30.0, 136.0, "Australia"), (2, "Nowhere Place", 1.0, 1.0, "")], "ord int, name string, lat double, lon double, country string")
        words = spark.createDataFrame([("bushveld",)], "keyword string")
        df = papers(spark, {"id": "the_bushveld_complex"}, {"id": "bushveld", "countries": ["South Africa"]}, {"id": "Cadia Ridgeway", "countries": ["Australia"]}, {"id": "ridgeway deposits", "countries": ["Chile"]}, {"id": "nowhere place", "countries": ["Mali"]}, {"id": "cadia ridgeway"})
        got = coords(enrich.tier_database(df, dim, words))
        assert got[1] is None  # 8 of 16 letters are too few
        assert coords(enrich.tier_database(papers(spark, {"id": "a dam"}), dim, words))[0] is None  # short words don't count
        assert got[0] is None or got[0]["confidence"] >= 0.6
        assert got[2] is not None and got[2]["latitude"] == -30
        assert got[3] is None and got[5] is None
        assert got[4]["matched_token"] == "nowhere place" and got[4]["precision"] == SITE_LEVEL  # no country fits all

    def test_ratio(self, spark):
        dim = spark.createDataFrame([(0, "Escondida", -24.0, -69.0, "Chile"), (1, "La Escondida Norte Mine", -24.1, -69.1, "Chile")], "ord int, name string, lat double, lon double, country string")
        df = papers(spark, {"id": "escondida-2010", "countries": ["Chile"]}, {"id": "escondida", "countries": ["Peru"]}, {"belt": "short one"})
        got = coords(enrich.tier_ratio(df, dim))
        assert got[0]["latitude"] == -24 and got[0]["confidence"] == 0.9 and got[1] is None and got[2] is None

    def test_overlay_and_expand(self, spark):
        base = self.belts(spark).select("ord", "name", "lat")
        over = spark.createDataFrame([(0, "Andes", 5.0), (1, "New", 6.0)], "ord int, name string, lat double")
        assert {(r["name"], r["lat"], r["ord"]) for r in lookup.overlay(base, over).collect()} == {("Jiaodong", 37.0, 0), ("Jiaodong–North", 38.0, 1), ("Andes", 5.0, 2), ("", 0.0, 3), ("New", 6.0, 4)}
        missing = spark.createDataFrame([(0, "Andes Norte"), (1, "Geocoded"), (2, "Lost")], "ord int, name string")
        geo = spark.createDataFrame([("Geocoded", 7.0, 8.0)], "name string, lat double, lon double")
        assert {(r["name"], r["lat"]) for r in enrich.expand_belts(missing, self.belts(spark), geo).collect()} == {("Andes Norte", -20.0), ("Geocoded", 7.0)}

    def test_polygon(self, spark):
        ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 2.0), (0.0, 10.0)]
        shapes = spark.createDataFrame([(0, "A", ring), (1, "B", [(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0)])], "ord int, country string, ring array<struct<lon:double,lat:double>>")
        pts = spark.createDataFrame([(0, 1.0, 5.0), (1, 8.0, 5.0), (2, 50.0, 5.0)], "_ord int, lat double, lon double")
        assert {r["_ord"]: r["country"] for r in lookup.containing_polygon(pts, F.col("lat"), F.col("lon"), shapes).collect()} == {0: "A", 1: "B"}


class TestValidate:
    def check(self, spark, *rows, **how):
        return [r["validation"] for r in validate.validate(papers(spark, *rows), **how).orderBy("_ord").collect()]

    def test_boxes(self, spark):
        got = self.check(
            spark, {}, {"place": place(None, 1.0)}, {"place": place(91.0, 10.0)}, {"place": place(-25.0, 133.0), "countries": ["Australia"]}, {"place": place(30.0, 100.0), "countries": ["Australia"]},
            {"place": place(0.0, -150.0), "countries": ["Chile"]}, {"place": place(38.0, 23.0), "countries": ["Greece"]}, {"place": place(-13.5, 139.0), "belt": "Pine Creek Orogen"}, {"place": place(-5.0, 10.0, 0.95, PROVINCE_LEVEL), "belt": "Northern arc"},
            {"place": place(10.0, 10.0, 0.5, SITE_LEVEL)},
        )
        assert got[0]["valid"] and got[0]["warnings"] == ["no coordinates"]
        assert not got[1]["valid"] and not got[2]["valid"] and len(got[2]["errors"]) == 1
        assert got[3]["valid"] and not got[3]["warnings"]
        assert not got[4]["valid"] and "China" in got[4]["errors"][0] and got[4]["suggestions"]
        assert got[5]["valid"] and len(got[5]["warnings"]) == 1  # in no box
        assert got[6]["valid"]  # a country that the boxes lack is neither right nor wrong
        assert got[7]["valid"] and "km from" in got[7]["warnings"][0]
        assert len(got[8]["warnings"]) == 3 and len(got[9]["warnings"]) == 1

    def test_polygons_and_places(self, spark):
        shapes = spark.createDataFrame([(0, "United States of America", [(-120.0, 30.0), (-80.0, 30.0), (-80.0, 45.0), (-120.0, 45.0)])], "ord int, country string, ring array<struct<lon:double,lat:double>>")
        rows = [{"place": place(40.0, -100.0), "countries": ["USA"]}, {"place": place(40.0, -100.0), "countries": ["Peru"]}, {"place": place(0.0, 0.0), "countries": ["USA"]}]
        got = self.check(spark, *rows, rules="polygons", polygons=shapes)
        assert [g["valid"] for g in got] == [True, False, True] and got[0]["suggestions"] and got[2]["warnings"]
        known = spark.createDataFrame([(40.0, -100.0, "United States")], "lat2 double, lon2 double, country string")
        got = self.check(spark, *rows, {"place": place(10.0, 10.0), "countries": ["South Korea"], "belt": ""}, rules="places", places=known)
        assert [g["valid"] for g in got] == [True, False, True, True] and not got[3]["warnings"]

    def test_stats(self, spark):
        v = validate.validate(papers(spark, {}, {"place": place(91.0, 0.0)}))
        assert tuple(validate.validation_stats(v).first()) == (2, 1, 1, 1)


class TestMonitor:
    @pytest.mark.parametrize(("value", "tonnage", "grade", "errors", "warnings"), [(91.0, None, None, 1, 0), (10.0, -1.0, None, 0, 1), (10.0, 100001.0, None, 0, 1), (10.0, 5.0, {"Cu_percent": 101.0, "Au_ppm": -0.1, "x": 500.0}, 2, 0), (0.0, 0.0, {}, 0, 0)])
    def test_values(self, spark, value, tonnage, grade, errors, warnings):
        df = spark.createDataFrame([(0, place(value, 10.0), ((tonnage, None, None), grade, None, None, None))], "_ord long, coordinates " + records.COORDINATES + ", deposit_scale struct<tonnage:struct<value:double,unit:string,resource_type:string>,grade:map<string,double>,scale_class:string,production_status:string,citation:string>")
        row = df.select(F.size(monitor.record_errors(df)).alias("e"), F.size(monitor.record_warnings(df)).alias("w")).first()
        assert tuple(row) == (errors, warnings)
        thresholds = {"coordinates": 0.65}
        assert monitor.exit_code(monitor.monitor(df, thresholds)) == (1 if errors else 2 if warnings else 0)

    @pytest.mark.parametrize(("filled", "ok"), [(64, False), (65, True), (66, True)])
    def test_fill(self, spark, filled, ok):
        df = spark.range(100).select(F.when(F.col("id") < filled, "x").otherwise("").alias("coordinates"))
        row = monitor.against_thresholds(monitor.fill_rates(df, ["coordinates"])).first()
        assert (row["filled"], row["ok"]) == (filled, ok)
        assert monitor.graded(monitor.fill_rates(df, ["coordinates"])).first()["grade"] == "fair"
        assert monitor.mean_fill(monitor.fill_rates(df, ["coordinates"])).select(monitor.verdict(F.col("mean_rate"))).first()[0] == "tune"
        assert monitor.fill_rates(df.limit(0), ["coordinates"]).first()["rate"] == 0


class TestScore:
    @pytest.mark.parametrize(("a", "b", "s"), [("VMS", "vms ", 1.0), ("LS-EPITH", "EPITHERMAL-LS", 1.0), ("VMS", "SMS", 0.5), ("VMS", "SKARN", 0.0), (None, "VMS", 0.0), ("", "", 0.0), ("ODD", "odd", 1.0), ("PORPHYRY CU", "PORPHYRY-MO", 0.5)])
    def test_match(self, spark, a, b, s):
        assert spark.createDataFrame([(a, b)], "a string, b string").select(score.score_match(F.col("a"), F.col("b"))).first()[0] == s

    def test_families(self):
        assert len(FAMILIES) == 21

    def test_references(self, spark):
        famous = spark.createDataFrame([(0, "Bingham", "PORPHYRY-CU-MO"), (1, "Bingham Canyon", "SKARN"), (2, "Kidd Creek", "VMS")], "ord int, name string, type string")
        df = spark.createDataFrame([(0, "p0", "PORPHYRY-CU", None, [("bingham",), ("",)]), (1, "p1", "VMS", None, [("Kidd Creek mine",), ("Bingham Canyon",)]), (2, "kidd creek study", "SKARN", "x", [])], "_ord long, paper_id string, deposit_type string, metallogenic_belt string, reference_deposits array<struct<name:string>>")
        got = {(r["_ord"], r["pos"]): (r["famous_name"], r["score"]) for r in score.match_references(df, famous).collect()}
        assert got == {(0, 0): ("Bingham", 0.5), (1, 0): ("Kidd Creek", 1.0), (1, 1): ("Bingham Canyon", 0.0)}
        assert tuple(score.evaluation(score.match_references(df, famous)).first()) == (2, 0.75, 1, 1, 0)
        found = {r["deposit"]: (r["status"], r["score"], r["matched_papers"]) for r in score.regression(df, famous).collect()}
        assert found["Bingham"] == ("PASS", 0.5, 1) and found["Bingham Canyon"] == ("FAIL", 0.0, 1) and found["Kidd Creek"] == ("FAIL", 0.0, 1)
        assert score.regression_report(score.regression(df, famous)).first()["testable"] == 3
        assert score.null_reasons(df.withColumns({"deposit_type": F.lit(None), "deposit_type_null_reason": F.lit(None).cast("string")})).first()["reason"] == "MISSING_FIELD"


class TestReview:
    def test_merge(self, spark):
        df = spark.createDataFrame([("a", "VMS"), ("b", "VMS"), ("c", "VMS"), ("d", "VMS"), ("e", "VMS")], "paper_id string, deposit_type string")
        reviews = spark.createDataFrame([("a", (True, "", None)), ("b", (False, "x" * 99, "SKARN")), ("c", (False, "", "N/A")), ("d", None)], "paper_id string, result struct<consistent:boolean,issues:string,suggested_type:string>")
        abstracts = spark.createDataFrame([("e", False, "MVT"), ("a", True, "VMS")], "paper_id string, consistent boolean, abstract_type string")
        merged = review.merge_reviews(df, reviews, abstracts)
        got = {r["paper_id"]: r for r in merged.collect()}
        assert got["a"]["_provenance"]["deposit_type_verified"] and got["a"]["_gate_flags"] is None
        assert got["b"]["_gate_flags"] == ["FLAG:adversarial_fail:" + "x" * 80, "FLAG:p2_suggests:SKARN"]
        assert got["c"]["_gate_flags"] == ["FLAG:p2_insufficient_abstract"] and got["d"]["_gate_flags"] is None
        assert got["e"]["_gate_flags"] == ["FLAG:metamorphic_inconsistency:MVT"]
        assert sorted(tuple(r) for r in review.flagged(merged).collect()) == [("b", "p2_fail"), ("e", "p7_inconsistent")]
        assert tuple(review.review_counts(reviews).first()) == (1, 1, 1, 1) and tuple(review.abstract_counts(abstracts).first()) == (1, 1)


class TestFigures:
    @pytest.mark.parametrize(("kind", "caption", "category"), [("Geological map", "", "geo_map"), ("map table", "geological map", "junk"), ("photo", "a Cross-Section", "cross_section"), ("plot", "Moho depth", "geophys_map"), (None, None, "junk")])
    def test_classes(self, spark, kind, caption, category):
        assert spark.createDataFrame([(kind, caption)], "k string, c string").select(figures.figure_class("k", "c")).first()[0] == category

    def test_results(self, spark):
        rows = [("p", "a/x.jpg", "image", "ok", '```json\n{"figure_type": "location map", "title_or_caption": "t"}\n```'), ("p", "y.jpg", "table", "ok", "<t>"), ("p", "z.jpg", "image", "empty", ""), ("p", "w.jpg", "image", "ok", "not json")]
        df = spark.createDataFrame(rows, "paper_id string, image_path string, task string, status string, output string")
        assert {r["category"]: r["n"] for r in figures.category_counts(df).collect()} == {"geo_map": 1, "junk": 1, "table_excluded": 1}
        refs = spark.createDataFrame([("x", ["l1", "l2"])], "image_id string, lines array<string>")
        got = {r["image_path"]: r for r in figures.attach_references(figures.classify_figures(df), refs).collect()}
        assert got["a/x.jpg"]["full_groundtruth"] == "t\n(body) l1\n(body) l2" and got["w.jpg"]["n_body_refs"] == 0

    def test_demotion(self, spark):
        qs = spark.createDataFrame([("1", "a.jpg"), ("2", "b.jpg")], "id string, image string")
        kept, text = figures.demote_guessable(qs, spark.createDataFrame([("2", True)], "id string, guessed boolean"))
        assert [r["id"] for r in kept.collect()] == ["1"] and text.columns == ["id", "source", "blind_test"] and text.count() == 1

    def test_injection(self, spark):
        docs = spark.createDataFrame([("p", "![](images/a.jpg)mid![cap](images/b.jpg)end"), ("q", "none")], "paper_id string, text string")
        res = spark.createDataFrame([("p", "b.jpg", "table", "ok", "```html\n<t>$1\\x</t>\n```", 0)], "paper_id string, image_basename string, task string, status string, output string, block_idx int")
        got = {r["paper_id"]: r["text"] for r in figures.inject_descriptions(docs, res).collect()}
        assert got == {"p": "![](images/a.jpg)mid<!-- TABLE: b.jpg -->\n<t>$1\\x</t>\n<!-- /TABLE -->end", "q": "none"}


class TestTemplates:
    RECORD = "paper_id string, deposit_type string, metallogenic_belt string, tectonic_setting string, host_rocks array<string>, structural_controls array<string>, alteration array<string>, minerals_mentioned array<string>, commodities array<string>, ages_ma array<double>"

    def test_full_and_empty(self, spark):
        full = ("p", "SKARN", "Pine Creek Orogen belt", "orogen", ["marble", "granite", "slate"], ["fault", "fold"], ["a", "b", "c"], ["quartz", "pyrite", "gold", "galena", "barite"], ["Pb", "Zn"], [1.0, 2.0])
        df = spark.createDataFrame([full, ("e", None, "", None, [], None, None, [], None, None)], self.RECORD)
        got = qa.expand(df).collect()
        assert len(qa.TEMPLATES) == 43 and len(got) == 22 and {r["paper_id"] for r in got} == {"p"}
        assert len({r["id"] for r in got}) == 22 and all(r["question"] and r["answer"] for r in got)
        every = qa.expand(df, dimensions={t.dimension for t in qa.TEMPLATES})
        assert every.count() == 43
        assert sum(r["n"] for r in qa.dimension_counts(every).collect()) == 43
        assert qa.expand(df, least_fields=10).count() == 0

    def test_guards(self, spark):
        df = spark.createDataFrame([("p", "VMS", "short belt", None, None, ["fault"], None, ["a"], ["Cu"], None)], self.RECORD)
        assert {r["template"] for r in qa.expand(df).collect()} == {"qa_structural_regional_context", "qa_structural_spatial"}


def test_reports(spark):
    df = spark.createDataFrame([("a", (10, 1)), ("b", (20, 3)), ("a", None)], "k string, tokens struct<input:long,output:long>")
    assert [tuple(r) for r in reports.histogram(df, "k", 1).collect()] == [("a", 2)]
    assert reports.usage(df, corpus=1000).first()["total_tokens"] == 34
    rows = [("A", "1", "2", None, None, "Cu", "Producer"), ("nan", "1", "2", "x", "y", "Cu", "Producer"), ("B", None, "2", "x", "y", "Cu", "Producer"), ("C", "1", "2", "x", "y", "Cu", "Prospect")]
    sites = spark.createDataFrame(rows, "site_name string, latitude string, longitude string, country string, dep_type string, commod1 string, dev_stat string")
    assert [r["name"] for r in reports.survey_rows(sites).collect()] == ["A"]
