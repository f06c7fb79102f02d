import json
import logging

import pytest

from tesserae.errors import BuildError
from tesserae.functions import normalize
from tesserae.operators import gates, matching
from tesserae.sources import decisions


def test_postal_rules(spark):
    addresses = spark.createDataFrame([(1, "A", "01", "本町一丁目"), (2, "A", "02", "本町二丁目"), (3, "A", "03", "nowhere"), (4, "B", "01", "x"), (5, "A", "04", "twin")], "id long, lg_code string, machiaza_id string, name string")
    codes = spark.createDataFrame([("A", "01", "001")], "lg_code string, machiaza_id string, postal_code string")
    records = spark.createDataFrame([("A", "本町２丁目（一部）", "002", "town"), ("A", "以下に掲載がない場合", "000", "no_listing"), ("A", "twin", "003", "town"), ("A", "twin", "004", "town")], "lg_code string, town_raw string, postal_code string, record_kind string")
    out = {(r.id, r.target, r.matching_rule_id, r.candidate_count_is_complete, r.relation_type) for r in matching.postal(addresses, codes, records).collect()}
    assert out == {(1, "001", "P1", True, "exact"), (2, "002", "P2", True, "exact"), (3, "000", "P3", False, "exact"), (4, None, "unresolved", True, "unresolved"), (5, "003", "P2", True, "ambiguous"), (5, "004", "P2", True, "ambiguous")}


def test_town_reference_rules(spark):
    addresses = spark.createDataFrame([(1, "A", "本町"), (2, "A", "大字三田"), (3, "A", "decided"), (4, "A", None)], "id long, lg_code string, name string")
    towns = spark.createDataFrame([("A", "m1", "本町"), ("A", "m2", "字三田"), ("A", "m3", "")], "lg_code string, mlit_code string, name string")
    decided = spark.createDataFrame([(3, "m9")], "id long, target string")
    out = {r.id: (r.target, r.matching_rule_id) for r in matching.town_reference(addresses, towns, decided).collect()}
    assert out == {1: ("m1", "M1"), 2: ("m2", "M3"), 3: ("m9", "M0"), 4: (None, "unresolved")}


def test_telephone_rules(spark):
    areas = spark.createDataFrame([("1", "北海道札幌市、石狩市（厚田、浜益に限る。）、江別市"), ("2", "石狩市（厚田を除く。）、somewhere"), ("3", None)], "area_code string, area_text string")
    clauses = matching.coverage_clauses(areas)
    found = {(r.area_code, r.pref_name, r.municipality_name, r.qualifier, r.coverage_type) for r in clauses.collect()}
    assert found == {("1", "北海道", "札幌市", None, "whole"), ("1", None, "石狩市", "厚田、浜益", "partial"), ("1", None, "江別市", None, "whole"), ("2", None, "石狩市", "厚田", "partial"), ("2", None, None, None, "unparsed")}
    towns = spark.createDataFrame([(1, "札幌市"), (2, "石狩市"), (3, "函館市")], "id long, name string")
    out = {(r.id, r.target, r.matching_rule_id, r.candidate_count) for r in matching.telephone(towns, clauses).collect()}
    assert out == {(1, "1", "T1", 1), (2, "1", "T3", 2), (2, "2", "T3", 2), (3, None, "unresolved", 0)}


def test_decisions_from_files(spark, tmp_path):
    path = tmp_path / "o.yml"
    path.write_text("overrides:\n- {id: a, table: bridge_x, where: {k: '01'}, set: {v: y}, decided_by: p}\n", encoding="utf-8")
    assert decisions.overrides(str(path), {"bridge_x"})[0]["where"] == {"k": "01"}
    for bad in ("overrides:\n- {id: a}\n- {id: a}\n", "other: []\n", "overrides:\n- {id: a, table: none, where: {k: 1}, set: {v: y}, decided_by: p}\n"):
        path.write_text(bad, encoding="utf-8")
        with pytest.raises(BuildError, match="VALIDATION_FAILED"):
            decisions.overrides(str(path), {"bridge_x"})
    path.write_text("recodes:\n- {old_area: '012', new_area: '013'}\n", encoding="utf-8")
    assert decisions.decided_table(spark, str(path), "recodes", ["old_area", "new_area"]).collect()[0] == ("012", "013")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    good, held = decisions.split_conflicts(df, ["k"], spark.createDataFrame([("a",)], "k string"))
    assert good.count() == 1 and held.count() == 2
    with pytest.raises(BuildError, match="DUPLICATE_KEY_ANOMALY"):
        decisions.split_conflicts(df, ["k"], spark.createDataFrame([("z",)], "k string"))


def test_diff_of_a_release(spark):
    row = "k string, relation_type string, confidence double, verification_status string, name string, code string"
    a = spark.createDataFrame([("1", "exact", 1.0, "auto", "n", "c"), ("2", "exact", 1.0, "auto", "m", "c")], row)
    b = spark.createDataFrame([("1", "ambiguous", 1.0, "auto", "old", "c"), ("3", "exact", 1.0, "auto", "m", "c")], row)
    keys = dict.fromkeys(("address", "bridge_x", "other"), "k")
    none = spark.createDataFrame([], "k string")
    assert gates.release_diff({"address": a}, None, keys, "address", none, "name", "code") == {"baseline": True, "tables": {"address": 2}}
    out = gates.release_diff({"address": a, "bridge_x": a, "other": a, "new": a}, {"address": b, "bridge_x": b, "other": b}, keys, "address", none, "name", "code")
    assert out["tables_added"] == ["new"] and out["address"]["unexplained"] == 1 and out["address"]["renamed"] == 1
    assert out["bridge_x"]["relation_type_changed"] == 1 and out["other"]["removed_sample"] == ["3"]
    now, before = (spark.createDataFrame(x, "metric string, value long") for x in ([("rows", 110), ("new", 1)], [("rows", 100), ("gone", 0)]))
    assert {r.metric: (r.change, r.pct_change) for r in gates.metrics_delta(now, before).collect()} == {"rows": (10, 10.0), "new": (None, None), "gone": (None, None)}


def test_logs_are_lines_of_json(capsys):
    logger = decisions.log_as_json("tesserae.test")
    logger.info("read %s", "x", extra={"context": {"rows": 3}})
    logger.handlers[0].flush()
    out = capsys.readouterr()
    assert not out.out
    record = logging.LogRecord("n", logging.INFO, "f", 1, "m %s", ("é",), None)
    assert json.loads(decisions.JsonLines().format(record)) == {"level": "INFO", "logger": "n", "message": "m é"}


def test_ascii_names_need_no_python(spark):
    names = ["a b\tc", "1-2", "x\x1cy\x0b z", "三 丁目", "é １", "", None, "１ー２"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.c for r in df.select(normalize.normalize_conservative(df.n).alias("c")).collect()] == [normalize.conservative(n) for n in names]
