"""What may grow with the tables is not broadcast, and pairs are made last."""

from pyspark.sql import functions as F

from tesserae.functions import mesh
from tesserae.operators import bridges, matching, points, versioning
from tesserae.plans import bridges as plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plots(spark):
    return spark.range(1, 4).selectExpr("id", "array(array(struct(130 + id * 0.003D AS x, 33.001D AS y), struct(130.031D + id * 0.003D AS x, 33.004D AS y), struct(130.01D + id * 0.003D AS x, 33.03D AS y))) AS rings")


def test_squares_of_runs_are_not_broadcast(spark):
    runs = mesh.build_runs(plots(spark), level=6)
    assert "Broadcast" not in plan(runs)
    assert runs.filter("size(ids) = 3").count() > 0


def test_runs_that_codes_met_are_not_broadcast(spark):
    runs = mesh.build_runs(plots(spark), level=6).localCheckpoint()
    codes = runs.select(runs.start.alias("code"), "ids").limit(3)
    found = mesh.run_lookup(codes.select("code"), runs)
    assert plan(found).count("BroadcastHashJoin") == 1  # a row a part
    assert {(r.code, tuple(r.ids)) for r in found.collect()} == {(r.code, tuple(r.ids)) for r in codes.collect()}


def test_clauses_are_not_broadcast(spark):
    areas = spark.range(1, 4).selectExpr("CAST(id AS STRING) AS area_code", "'甲市（東区を除く）、乙町' AS area_text")
    wards = spark.createDataFrame([("甲市", "東区"), ("甲市", "西区")], "municipality_name string, ward string")
    found = matching.ward_coverage(areas, wards)
    assert "Broadcast" not in plan(found)
    assert {(r.ward, r.coverage) for r in found.collect()} == {("東区", "none"), ("西区", "whole")}


def test_points_meet_their_candidates_in_tasks_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(bridges, "ENTITIES", 100)
    dots = spark.range(10_000).selectExpr("id", "130 + id / 100000D AS x", "33.0105D AS y")
    squares = plots(spark).selectExpr("id AS shape_id", "'c' || id AS code", "rings")
    names = squares.selectExpr("code", "'l' || code AS lg_code")
    found = bridges.point_bridge(dots, squares, names, names.limit(0))
    assert found.groupBy(F.spark_partition_id()).count().count() == 100
    monkeypatch.undo()
    assert sorted(map(tuple, found.fillna("-").collect())) == sorted(map(tuple, bridges.point_bridge(dots, squares, names, names.limit(0)).fillna("-").collect()))
    assert {r.candidate_count for r in found.select("candidate_count").distinct().collect()} > {0, 1, 2}


def test_points_are_summed_up_where_they_are(spark, sf_dir):
    assert "Expand" not in plan(plans.QUERIES["bridge_point_polygon"](spark, sf_dir))


def test_candidates_are_paired_last(spark):
    addresses = spark.range(1, 41).selectExpr("id", "'l' || id % 2 AS lg_code", "'m' || id AS machiaza_id", "'n' AS name")
    codes = spark.createDataFrame([("l0", "m2", "c"), ("l0", "m2", "c"), ("l1", None, "c")], "lg_code string, machiaza_id string, postal_code string")
    records = spark.range(2500).selectExpr("'l0' AS lg_code", "'o' AS town_raw", "'p' || id % 1250 AS postal_code", "'no_listing' AS record_kind")
    found = matching.postal(addresses, codes, records)
    above = plan(found).split("Generate")[0]
    assert "Generate" in plan(found) and "Exchange" not in above
    counts = {r.id: (r.matching_rule_id, r.n, r.c, r.k) for r in found.groupBy("id", "matching_rule_id").agg({"*": "count", "candidate_count": "max", "target": "count"}).toDF("id", "matching_rule_id", "k", "n", "c").collect()}
    assert {i: sorted(x for x in c[1:]) for i, c in counts.items() if c[0] == "P3"} == {i: [1250] * 3 for i in range(4, 41, 2)}
    assert counts[2][0] == "P1" and {c[0] for i, c in counts.items() if i % 2} == {"unresolved"}


def test_entities_with_several_rows_have_the_candidates_of_all(spark):
    entities = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "a"), (3, "c")], "id long, name string")
    targets = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", None)], "name string, target string")
    found = bridges.cascade(entities, [("R", 1.0, bridges.By({"name": F.col("name")}, targets))])
    assert {(r.id, r.target, r.candidate_count) for r in found.collect()} == {(1, "x", 2), (1, "y", 2), (2, "y", 1), (None, None, 0), (3, None, 0)}


def test_claims_of_one_name_are_not_paired(spark):
    ledger = spark.range(300).selectExpr("'e' || id AS entity_id", "'a' AS area", "'c' || id AS code", "CASE WHEN id = 7 THEN 'own' ELSE 'n' END AS name", "true AS active")
    towns = spark.range(300).selectExpr("'a' AS area", "'d' || id AS code", "CASE WHEN id = 9 THEN 'own' ELSE 'n' END AS name")
    found = versioning.resolve_identity(towns, ledger, spark.createDataFrame([("a", "b")], "old_area string, new_area string"))
    assert "count(distinct" not in plan(found)
    rows = {(r.rule, r.review): r["count"] for r in found.groupBy("rule", "review").count().collect()}
    assert rows == {("I2", None): 1, ("I5", "I2_ambiguous"): 299}
    assert found.filter("rule = 'I2'").select("code", "entity_id").first() == ("d9", "e7")


def test_towns_of_schools_are_paired_last(spark):
    schools = spark.range(1, 5).selectExpr("id AS school_code", "'l' AS lg_code", "'ab' || id AS address", "'p' AS postal_code")
    towns = spark.range(2500).selectExpr("id AS address_id", "'l' AS lg_code", "CASE WHEN id = 0 THEN 'ab1' WHEN id % 2 = 0 THEN 'ab' ELSE 'a' END AS name")
    found = points.school_bridge(schools, towns, towns.limit(1).selectExpr("address_id", "'p' AS postal_code"))
    assert "Generate" in plan(found) and "Exchange" not in plan(found).split("Generate")[0]
    counts = {r.school_code: r["count"] for r in found.groupBy("school_code").count().collect()}
    assert counts == {1: 1, 2: 1249, 3: 1249, 4: 1249} and found.filter("postal_check = 'matches'").count() == 1


def test_pairs_of_schools_are_spread_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(points, "PAIRS", 5000, raising=False)
    monkeypatch.setattr(points, "CROWD", 10, raising=False)
    schools = spark.range(200).selectExpr("id AS school_code", "'l' AS lg_code", "'ab' || id AS address", "'p' AS postal_code")
    towns = spark.range(500).selectExpr("id AS address_id", "'l' AS lg_code", "'ab' AS name")
    found = points.school_bridge(schools, towns, towns.limit(1).selectExpr("address_id", "'p' AS postal_code"))
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]  # one name, few bytes
    assert sum(tasks) == 100_000 and len(tasks) >= 8 and max(tasks) <= 30_000
    assert plan(found).count("REPARTITION_BY_NUM") == 4  # before rows multiply, and where they meet
    assert found.distinct().count() == 100_000 and found.filter("postal_check = 'matches'").count() == 200


def test_one_repeated_school_does_not_pair_the_others_early(spark):
    schools = spark.createDataFrame([(1, "l", "ab1", "p"), (1, "l", "abc", "q"), (2, "l", "ab2", "p"), (None, "l", "ab3", "p"), (3, "l", "z", "p")], "school_code long, lg_code string, address string, postal_code string")
    towns = spark.createDataFrame([(7, "l", "ab"), (8, "l", "ab"), (9, "l", "abc")], "address_id long, lg_code string, name string")
    found = points.school_bridge(schools, towns, towns.limit(1).selectExpr("address_id", "'p' AS postal_code"))
    assert "explode(values" in plan(found)
    rows = {(r.school_code, r.address_id, r.candidate_count, r.postal_check) for r in found.collect()}
    assert rows == {(1, 9, 2, "differs"), (2, 7, 2, "matches"), (2, 8, 2, "differs"), (None, None, 0, None), (3, None, 0, None)} and found.count() == 6
