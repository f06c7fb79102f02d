"""Containment by bands of edges, and runs of squares, against the ray cast."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tesserae.functions import mesh
from tesserae.operators import spatial

RINGS = "shape_id int, code string, rings array<array<struct<x:double,y:double>>>"


def wavy(n, cx, cy, r, turns, amplitude):
    """A star-like ring of ``n`` vertices."""
    return [(cx + math.cos(t) * r * (1 + amplitude * math.sin(turns * t)), cy + math.sin(t) * r * (1 + amplitude * math.cos(turns * t + 1))) for t in (2 * math.pi * i / n for i in range(n))]


def cast(x, y, rings):
    odd = False
    for ring in rings:
        if len(ring) > 2:
            for (ax, ay), (bx, by) in zip([ring[-1], *ring[:-1]], ring, strict=True):
                if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                    odd = not odd
    return odd


def check(spark, shapes, points, cell):
    df = spark.createDataFrame([(i, x, y, "s", 1.0, 2) for i, (x, y) in enumerate(points)], "id int, x double, y double, code2 string, scale double, band int")
    made = spark.createDataFrame([(i, f"c{i}", [[{"x": x, "y": y} for x, y in r] for r in rings]) for i, rings in enumerate(shapes)], RINGS)
    have = sorted((r.id, r.code) for r in spatial.containment_join(df, made, cell).collect())
    assert have == sorted((i, f"c{j}") for i, (x, y) in enumerate(points) if x is not None and y is not None for j, rings in enumerate(shapes) if cast(x, y, rings))
    return have


def test_shapes_of_all_kinds(spark, monkeypatch):
    rng = random.Random(3)
    comb = [(0.0, 0.0)] + [p for i in range(40) for p in ((i / 4, 5.0), (i / 4 + 0.1, 0.5))] + [(10.0, 5.0), (10.0, 0.0)]
    bow = [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0)]
    shapes = [
        [wavy(300, 5, 5, 3, 9, 0.3), wavy(40, 5, 5, 1, 3, 0.1)], [comb], [bow], [[(0.0, 0.0), (1.0, 1.0)]], [], [[(2.0, 2.0)] * 5], [[(-50.0, -1.0), (60.0, -0.9), (60.0, 11.0), (-50.0, 11.2)]],
        [[(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)], [(4.0, 4.0), (5.0, 4.0), (5.0, 5.0), (4.0, 5.0)]],
    ]
    points = [(rng.uniform(-1, 11), rng.uniform(-2, 12)) for _ in range(1500)] + [(float(x), float(y)) for x in range(0, 6) for y in range(0, 6)] + [(None, 1.0), (1.0, None), (float("nan"), 1.0)]
    for few in (0, spatial.FEW):  # the cells and edges sent to the points, or all sides dealt out
        monkeypatch.setattr(spatial, "FEW", few)
        for cell in ((0.5, 0.5), (3.0, 0.2), (100.0, 100.0)):
            check(spark, shapes, points, cell)


def test_a_ring_of_100000_vertices(spark):
    rings = [wavy(100_000, 0.0, 0.0, 1.0, 50, 0.2), wavy(20_000, 0.1, 0.0, 0.3, 20, 0.2), wavy(1000, -0.4, -0.3, 0.1, 7, 0.1)]
    rng = random.Random(1)
    points = [(rng.uniform(-1.3, 1.3), rng.uniform(-1.3, 1.3)) for _ in range(60)]
    assert 15 < len(check(spark, [rings], points, (0.05, 0.05))) < 55
    made = spark.createDataFrame([(0, "c", [[{"x": x, "y": y} for x, y in r] for r in rings])], RINGS)
    _, bands = spatial.covering(made, (0.05, 0.05))
    rows, most = bands.agg(F.sum(F.size("edges")), F.max(F.size("edges"))).first()
    assert rows <= 2 * 121_000 and most < 400


@pytest.mark.parametrize("few", [0, spatial.FEW])
def test_no_ring_stands_beside_a_point(spark, monkeypatch, few):
    monkeypatch.setattr(spatial, "FEW", few)
    made = spark.createDataFrame([(0, "c", [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 1.0}]])], RINGS)
    points = spark.range(10).selectExpr("id", "id / 10.0d AS x", "0.2d AS y")
    plan = spatial.containment_join(points, made, (0.5, 0.5))._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().split("\n") if "Join" in line]
    assert joins and all("rings" not in line for line in joins)


def test_runs_of_squares(spark):
    rng = random.Random(7)
    shapes = [[wavy(60, 135.05, 35.05, 0.05, 5, 0.3), wavy(9, 135.05, 35.05, 0.012, 2, 0.1)], [wavy(20, 135.12, 35.08, 0.04, 3, 0.2)], [[(135.0, 35.0), (135.3, 35.0), (135.3, 35.25), (135.0, 35.25)]]]
    made = spark.createDataFrame([(i, [[{"x": x, "y": y} for x, y in r] for r in rings]) for i, rings in enumerate(shapes)], "id int, rings array<array<struct<x:double,y:double>>>")
    for level in (3, 5, 6):
        per_lat, per_lng = 120 * 2 ** (level - 3), 80 * 2 ** (level - 3)
        runs = mesh.build_runs(made, level).persist()
        rows = sorted((r.start, r.len, tuple(r.ids), r.uniform) for r in runs.collect())
        assert all(a[0] + a[1] <= b[0] for a, b in zip(rows, rows[1:], strict=False))  # disjoint, and no longer run could be made
        assert not any(a[0] + a[1] == b[0] and a[2:] == b[2:] for a, b in zip(rows, rows[1:], strict=False))
        points = [(rng.uniform(134.98, 135.32), rng.uniform(34.98, 35.27)) for _ in range(400)]
        df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double")
        row, col = F.floor(F.col("y") * per_lat).cast("long"), F.floor(F.col("x") * per_lng).cast("long")
        coded = df.withColumn("code", mesh.square_number(row, col, level))
        uniform = mesh.run_lookup(coded, runs.filter("uniform")).filter("ids IS NOT NULL").collect()
        for r in uniform:
            assert [j for j, rings in enumerate(shapes) if cast(r.x, r.y, rings)] == r.ids
        found = {r.id: r.ids or [] for r in mesh.run_lookup(coded, runs).collect()}
        for i, (x, y) in enumerate(points):  # what holds a point reaches its square
            assert {j for j, rings in enumerate(shapes) if cast(x, y, rings)} <= set(found[i])
        assert level == 3 or uniform
        runs.unpersist()


def test_third_order_numbers_are_the_codes(spark):
    df = spark.createDataFrame([(35.6812, 139.7671), (43.06, 141.35)], "lat double, lng double")
    third = mesh.square_number(F.floor(F.col("lat") * 120).cast("long"), F.floor(F.col("lng") * 80).cast("long"), 3)
    assert all(r[0] == r[1] for r in df.select(third, mesh.mesh3(F.col("lat"), F.col("lng"))).collect())


def test_the_sweep(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = [(0, 10**9, [7]), (10**9 + 5, 1, [1, 2]), (10**9 + 6, 3, [65535])]
        codes = [0, 1, 5 * 10**8, 10**9 - 1, 10**9, 10**9 + 5, 10**9 + 6, 10**9 + 8, 10**9 + 9, -1, 10**9 + 5, None]
        r = spark.createDataFrame(runs, "start long, len long, ids array<int>")
        have = sorted(((x.code, x.kind) for x in mesh.run_lookup(spark.createDataFrame([(c, "k") for c in codes], "code long, run string"), r).collect()), key=repr)
        kind = lambda c: next((("ambiguous" if len(i) > 1 else "unknown" if i == [65535] else "contains") for s, n, i in runs if c is not None and s <= c < s + n), "none")
        assert have == sorted(((c, kind(c)) for c in codes), key=repr)
        overlapping = spark.createDataFrame([(0, 10, [1]), (9, 2, [2])], "start long, len long, ids array<int>")
        try:
            mesh.run_lookup(spark.createDataFrame([(3,)], "code long"), overlapping).collect()
        except Exception as e:
            assert "VALIDATION_FAILED" in str(e)
        else:
            raise AssertionError("runs that overlap passed")
        assert mesh.run_lookup(spark.createDataFrame([(3,)], "code long"), r.limit(0)).first().kind == "none"
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
