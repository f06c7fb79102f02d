"""Names that nearly agree, hash trees of releases, references in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from tesserae.operators import gates, matching, similarity, trees


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_no_pair_is_lost(spark, most):
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("ab町é") for _ in range(rng.choice((0, 1, 2, 3, 4, 5, 6, 9, 14))))

    def near(name):
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(name) + 1)
            name = rng.choice((name[:i] + rng.choice("ab町é") + name[i:], name[:i] + name[i + 1 :], name[:i] + rng.choice("ab") + name[i + 1 :]))
        return name

    left = [(rng.choice("xyz"), word()) for _ in range(150)]
    right = [(b, near(n)) for b, n in left] + [(rng.choice("xyz"), word()) for _ in range(60)] + [(None, "a"), ("x", None)]
    frame = lambda rows: spark.createDataFrame([(b, n, "k") for b, n in rows], "block string, name string, side string")
    have = sorted(tuple(r) for r in similarity.similar_names(frame(left), frame(right), most).collect())
    want = sorted({(b, n, m, edits(n, m)) for b, n in left for c, m in right if b == c and m is not None and edits(n, m) <= most})
    assert have == want and want


def test_names_that_disagree(spark):
    addresses = spark.createDataFrame([(1, "1", "桜ケ丘町"), (2, "1", "緑町一丁目"), (3, "1", "東本町"), (4, "1", "遠い名前の町"), (5, "2", "桜ケ丘町"), (6, "1", "中央")], "id long, lg_code string, name string")
    towns = spark.createDataFrame([("1", "m1", "桜ヶ岡町"), ("1", "m2", "緑町二丁目"), ("1", "m3", "緑町三丁目"), ("1", "m4", "大字東本町"), ("1", "m5", "中央")], "lg_code string, mlit_code string, name string")
    found = {(r.id, r.target, r.matching_rule_id, r.relation_type, r.verification_status) for r in matching.town_reference(addresses, towns, most=2).collect()}
    assert found == {
        (1, "m1", "M2", "equivalent", "review_required"), (2, "m2", "M4", "ambiguous", "review_required"), (2, "m3", "M4", "ambiguous", "review_required"), (3, "m4", "M3", "exact", "auto"),
        (4, None, "unresolved", "unresolved", "review_required"), (5, None, "unresolved", "unresolved", "review_required"), (6, "m5", "M1", "exact", "auto"),
    }


def test_equal_ranges_are_not_read_again(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id AS k", "cast(id % 7 AS string) AS v", "if(id % 5 = 0, null, id) AS w", "current_timestamp() AS created_at")
    later = rows.withColumn("v", F.when(F.col("k") == 1234, "new").otherwise(F.col("v"))).filter("k <> 77").unionByName(rows.filter("k = 500")).withColumn("created_at", F.lit("2020-01-01").cast("timestamp"))
    for name, df in (("a", rows), ("b", later), ("c", rows)):
        trees.write_tree(df, f"{tmp_path}/{name}", ["k"], depth=2)
    where = lambda n: f"{tmp_path}/{n}"
    leaves = trees.differing_leaves(spark, where("b"), where("a"))
    assert 1 <= len(leaves) <= 3 and trees.differing_leaves(spark, where("c"), where("a")) == []
    found = trees.tree_diff(spark, where("b"), where("a"))
    plain = gates.multiset_differences(later, rows)
    assert sorted(map(tuple, found.select(*plain.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [leaf" in plan.replace("isnotnull(leaf", "leaf") and "leaf" in plan
    read = {f.split("leaf=")[1].split("/")[0] for f in spark.read.parquet(f"{where('b')}/rows").filter(F.col("leaf").isin(leaves)).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert read <= set(map(str, leaves))
    assert trees.tree_diff(spark, where("c"), where("a")).count() == 0


def test_trees_of_empty_tables(spark, tmp_path):
    rows = spark.range(5).selectExpr("id AS k", "'x' AS v")
    trees.write_tree(rows, f"{tmp_path}/a", ["k"], depth=1)
    trees.write_tree(rows.filter("k = 1"), f"{tmp_path}/b", ["k"], depth=1)
    assert sorted(map(tuple, trees.tree_diff(spark, f"{tmp_path}/b", f"{tmp_path}/a").collect())) == [(k, "x", -1) for k in (0, 2, 3, 4)]


def test_references(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (9, "a")], "k long, v string")
    parent = spark.createDataFrame([(1, "a"), (2, "x")], "k int, v string")
    out = trees.check_references({"child": child, "parent": parent, "none": child.limit(0)}, [("child", "k", "parent", "k"), ("child", "v", "parent", "v"), ("none", "k", "parent", "k"), ("child", "k", "none", "k")])
    assert {tuple(r) for r in out.collect()} == {
        ("child.k -> parent.k", 4, 1, 1, "9"), ("child.v -> parent.v", 4, 2, 2, "b"), ("none.k -> parent.k", 0, 0, 0, None), ("child.k -> none.k", 4, 4, 3, "1"),
    }
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    of_keys = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line and "key#" in line]
    assert len(of_keys) == 1 and " Exchange hashpartitioning(" in of_keys[0]
