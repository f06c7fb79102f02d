"""History in bucketed tables against the plain rule; release files that come out the same."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tesserae.errors import BuildError
from tesserae.operators import history, versioning
from tesserae.sources import release_files

VERSION = "k long, name string, nation string, observed_from string, observed_to string, is_current boolean, ver_id string"


@pytest.mark.parametrize("placed", [False, True])
def test_ten_releases(spark, tmp_path, placed):
    rng = random.Random(4)
    h = history.History(spark, f"h{uuid.uuid4().hex[:8]}", "k", "ver_id", buckets=4, folder=f"{tmp_path}/tables" if placed else None)
    plain = None
    try:
        for n in range(10):
            stamp = f"2026-01-{(n + 1 if n != 6 else 3):02d}"  # one is older than the release before
            rows = [(k, f"n{k}", rng.choice("ab"), stamp, None, True, f"v{n}-{k}") for k in range(30) if rng.random() < 0.8]
            current = spark.createDataFrame(rows, VERSION)
            h.advance(current, n, stamp)
            plain = spark.createDataFrame(versioning.carry_forward(current, plain, "k", "ver_id", stamp).collect() or [], VERSION)
            if n in (1, 9):
                assert sorted(map(repr, h.rows(n).select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
        h.advance(current, 9, stamp)  # once more, as after a failure
        assert sorted(map(repr, h.rows(9).select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
        assert h.rows(3).count() < h.rows(9).count()
        plan = h.joined(current, 9)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        held, new = plan.split("SortMergeJoin", 1)[1].split("\n", 1)[1], plan
        assert plan.count("Exchange") == 1 and "Bucketed: true" in held  # this release's rows alone are shuffled
    finally:
        for n in range(10):
            h.drop(n)
        spark.sql(f"DROP TABLE IF EXISTS {h.name}_closed")


def test_files_do_not_depend_on_partitions(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id % 700 AS k", "if(id % 11 = 0, null, cast(id % 13 AS string)) AS v", "array(id % 3) AS a", "cast(id % 5 AS double) AS tie")
    made = []
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for parts, shuffle, coalesce in ((1, "1", "true"), (7, "4", "false"), (3, "13", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
            made.append(release_files.write_release(rows.repartition(parts), f"{tmp_path}/{parts}", ["k"], rows_per_file=999))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert len({m["digest"] for m in made}) == 1 and made[0]["rows"] == 5000 and [f["rows"] for f in made[0]["files"]] == [999] * 5 + [5]
    assert [f["sha256"] for f in made[0]["files"]] == [f["sha256"] for f in made[1]["files"]]
    back = release_files.read_release(spark, f"{tmp_path}/7")
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    release_files.check_release(spark, f"{tmp_path}/7")
    name = json.load(open(f"{tmp_path}/7/manifest.json"))["files"][2]["name"]
    open(f"{tmp_path}/7/{name}", "ab").write(b"x")
    with pytest.raises(BuildError, match="CHECKSUM_MISMATCH"):
        release_files.check_release(spark, f"{tmp_path}/7")


def test_rows_in_order_as_text(spark, tmp_path):
    import gzip

    rows = spark.createDataFrame([(3, "c"), (1, "é, \"x\""), (2, None)], "k long, v string")
    m = release_files.write_release(rows.repartition(3), f"{tmp_path}/t", ["k"], rows_per_file=2, kind="csv.gz")
    data = b"".join(open(f"{tmp_path}/t/{f['name']}", "rb").read() for f in m["files"])
    assert gzip.decompress(data).decode() == 'k,v\n1,"é, ""x"""\n2,\n3,c\n'
    empty = release_files.write_release(rows.limit(0), f"{tmp_path}/e", ["k"])
    assert empty["rows"] == 0 and release_files.read_release(spark, f"{tmp_path}/e").count() == 0


def test_places(spark):
    rows = spark.createDataFrame([(i % 4, None if i % 3 else "x") for i in range(50)], "k long, v string")
    found = sorted((r["place in the order"], r.k, r.v or "") for r in release_files.ranked(rows.repartition(5), ["k"]).collect())
    assert [f[0] for f in found] == list(range(50)) and [f[1:] for f in found] == sorted((k, v or "") for k, v in rows.collect())
