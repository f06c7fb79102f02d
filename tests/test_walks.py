import pytest

from tesserae.operators import versioning


def test_walks_longer_than_the_rounds_are_an_error(spark):
    edges = spark.createDataFrame([(f"c{i}", f"c{i + 1}", f"{i:03d}", True) for i in range(4)], "old string, new string, date string, is_unique boolean")
    roots = spark.createDataFrame([("c0",)], "code string")
    assert [tuple(r) for r in versioning.walk(roots, edges, rounds=5).collect()] == [("c0", "c4", "003", True)]
    with pytest.raises(RuntimeError, match="3 rounds"):
        versioning.walk(roots, edges, rounds=3)


def chain(spark, n):
    return spark.createDataFrame([(f"c{i}", f"c{i + 1}", f"{i:05d}", i != 3, "x") for i in range(n)], "old string, new string, date string, is_unique boolean, event string")


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(versioning, "durable", lambda df, real=versioning.durable: written.append(1) or real(df))
    roots = spark.createDataFrame([("c0",), ("c990",), ("nowhere",), (None,)], "code string")
    found = {tuple(r) for r in versioning.walk(roots, chain(spark, 1000)).collect()}
    assert found == {("c0", "c1000", "00999", False), ("c990", "c1000", "00999", True), ("nowhere", "nowhere", "", True), (None, None, "", True)}
    assert len(written) <= 12  # the first step, then at most 11 rounds


def test_walks_with_their_steps(spark):
    edges = spark.createDataFrame(
        [("a", "b", "1", True), ("a", "b", "1", True), ("b", "c", "2", True), ("b", "d", "2", False), ("d", "a", "3", True), ("a", "e", "4", True), ("b", "b", "9", True), ("c", "b", "0", True)],
        "old string, new string, date string, is_unique boolean",
    )
    found = {(r.root, r.code, r.since, r.all_unique, r.steps, tuple((h.old, h.new, h.date) for h in r.hops)) for r in versioning.walks(spark.createDataFrame([("a",), ("a",)], "code string"), edges.withColumn("n", edges.date), "n").collect()}
    long = (("a", "b", "1"), ("b", "d", "2"), ("d", "a", "3"), ("a", "e", "4"))
    assert found == {("a", "c", "2", True, 2, (("a", "b", "1"), ("b", "c", "2"))), ("a", "e", "4", False, 4, long), ("a", "e", "4", True, 1, (("a", "e", "4"),))}
