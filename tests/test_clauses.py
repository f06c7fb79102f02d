"""Coverage clauses as trees, and what follows from them for wards, municipalities and towns."""

from tesserae.operators import matching

NESTED = "北海道札幌市（北区、東区（一部、二部を除く）を除く）、小樽市"


def areas(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts, 1)], "area_code string, area_text string")


def test_nested_brackets(spark):
    found = {(r.municipality_name, r.qualifier, r.coverage_type, r.exception_text, r.clause_raw) for r in matching.coverage_clauses(areas(spark, NESTED)).collect()}
    inner = "北区、東区（一部、二部を除く）"
    assert found == {("札幌市", inner, "partial", inner, NESTED.removesuffix("、小樽市")), ("小樽市", None, "whole", None, "小樽市")}


def test_three_levels(spark):
    text = "甲市（乙区（一（い、ろに限る）、二を除く）に限る）"
    rows = {r.name: (r.depth, r["mode"], r.included, r.raw) for r in matching.clause_tree(areas(spark, text)).collect()}
    assert rows == {
        "甲市": (0, "only", True, text), "乙区": (1, "except", True, "乙区（一（い、ろに限る）、二を除く）"), "一": (2, "only", False, "一（い、ろに限る）"), "い": (3, None, False, "い"),
        "ろ": (3, None, False, "ろ"), "二": (2, None, False, "二"),
    }


def test_texts_that_are_no_clauses(spark):
    rows = matching.clause_tree(areas(spark, None, "", "、、", "）丙市", "（丁）、戊市（己", "（）", "庚市（（い）を除く）")).collect()
    names = {}
    for r in rows:
        names.setdefault(r.area_code, []).append((r.depth, r.name, r["mode"], r.raw))
    assert {k: sorted(v, key=repr) for k, v in names.items()} == {
        "4": [(0, "）", None, "）丙市")], "5": sorted([(0, "", "note", "（丁）"), (1, "丁", None, "丁"), (0, "戊市", "note", "戊市"), (1, "己", None, "己")], key=repr), "6": [(0, "", None, "（）")],
        "7": sorted([(0, "庚市", "except", "庚市（（い）を除く）"), (1, "", "note", "（い）"), (2, "い", None, "い")], key=repr),
    }
    assert {r.coverage_type for r in matching.coverage_clauses(areas(spark, "）丙市", "（丁）", "江別市（旧）")).collect()} == {"unparsed"}


def test_wards(spark):
    wards = spark.createDataFrame([("札幌市", w) for w in ("北区", "東区", "西区")] + [("石狩市", w) for w in ("厚田", "浜益", "他")] + [("小樽市", "全")], "municipality_name string, ward string")
    found = {(r.area_code, r.ward): r.coverage for r in matching.ward_coverage(areas(spark, NESTED, "石狩市（厚田、浜益に限る。）、石狩市（厚田、他（一部に限る）に限る）"), wards).collect()}
    assert found == {("1", "北区"): "none", ("1", "東区"): "partial", ("1", "西区"): "whole", ("1", "全"): "whole", ("2", "厚田"): "whole", ("2", "浜益"): "whole", ("2", "他"): "partial"}


def test_rules_of_municipalities_and_towns(spark):
    clauses = matching.coverage_clauses(areas(spark, "甲市、乙市", "乙市、丙市（一に限る）", "丙市（一を除く）、丁市"))
    towns = spark.createDataFrame([(i, n) for i, n in enumerate(("甲市", "乙市", "丙市", "丁市", "戊市"))], "id long, name string")
    decided = spark.createDataFrame([(3, "9")], "id long, target string")
    found = {(r.id, r.target, r.matching_rule_id, r.relation_type, r.candidate_count_is_complete) for r in matching.telephone(towns, clauses, decided).collect()}
    assert found == {
        (0, "1", "T1", "exact", True), (1, "1", "T6", "ambiguous", True), (1, "2", "T6", "ambiguous", True), (2, "2", "T3", "ambiguous", False), (2, "3", "T3", "ambiguous", False),
        (3, "9", "T0", "exact", True), (4, None, "unresolved", "unresolved", True),
    }
    rows = {(r.id, r.target, r.matching_rule_id, r.candidate_count) for r in matching.telephone_of_towns(towns.select("id"), decided).collect()}
    assert rows == {(3, "9", "T0", 1)} | {(i, None, "T10", 0) for i in (0, 1, 2, 4)}
    assert {r.matching_rule_id for r in matching.telephone_of_towns(towns.select("id")).collect()} == {"T10"}
