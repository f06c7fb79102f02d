import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesserae.errors import BuildError
from tesserae.functions import geo_pack, mesh, normalize
from tesserae.operators import bridges, gates, points, spatial, versioning

RINGS = "array<array<struct<x:double,y:double>>>"
square = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def inside(x, y, rings):
    """Winding by angles is no use on borders; this is the plain even-odd rule on exact fractions."""
    from fractions import Fraction as Q

    hits = 0
    for ring in rings:
        if len(ring) >= 3:
            for (ax, ay), (bx, by) in zip(ring[-1:] + ring[:-1], ring, strict=True):
                if (ay > y) != (by > y) and Q(x) < Q(ax) + (Q(y) - Q(ay)) * (Q(bx) - Q(ax)) / (Q(by) - Q(ay)):
                    hits += 1
    return hits % 2 == 1


def test_containment_rules(spark):
    hole = [square(0, 0, 10, 10), square(3, 3, 7, 7)]
    diamond = [[(5, 0), (10, 5), (5, 10), (0, 5)]]
    closed = [square(0, 0, 4, 4) + [(0, 0)]]
    cases = [(x / 2, y / 2, rings) for rings in (hole, diamond, closed, [[(0, 0), (5, 5)]], []) for x in range(-1, 22) for y in range(-1, 22)]
    df = spark.createDataFrame([(i, float(x), float(y), [[(float(a), float(b)) for a, b in r] for r in rings]) for i, (x, y, rings) in enumerate(cases)], f"i int, x double, y double, rings {RINGS}")
    from pyspark.sql import functions as F

    found = {r.i: r.hit for r in df.select("i", spatial.in_rings(F.col("x"), F.col("y"), F.col("rings")).alias("hit")).collect()}
    assert [found[i] for i in range(len(cases))] == [inside(*c) for c in cases]


def lines(spark, rows):
    return spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in p] for p in parts]) for i, parts in rows], f"id int, parts {RINGS}")


def test_placement_points(spark):
    rows = [(1, [[(0, 0), (10, 0)]]), (2, [[(0, 0), (0, 10), (10, 10), (10, 0)]]), (3, [[(2, 3), (2, 3)]]), (4, []), (5, [[(0, 0), (2, 0)], [(10, 0), (14, 0)]])]
    df = lines(spark, rows)
    centroid = {r.id: (r.x, r.y) for r in spatial.line_centroid(df).collect()}
    assert centroid[1] == (5, 0) and centroid[2] == pytest.approx((5, 20 / 3)) and centroid[3] == (2, 3) and centroid[4] == (None, None)
    half = {r.id: (r.x, r.y) for r in spatial.point_on_line(df).collect()}
    assert half == {1: (5, 0), 2: (5, 10), 3: (2, 3), 4: (None, None), 5: (11, 0)}
    how = spark.createDataFrame([(2, "point_on_line")], "id int, how string")
    assert {r.id: (r.x, r.y, r.how) for r in spatial.representative_point(df, how).collect()}[2] == (5, 10, "point_on_line")


@pytest.fixture
def world(spark):
    shapes = [(1, "W", square(0, 0, 1, 1)), (2, "E", square(1, 0, 2, 1)), (3, "OVER", square(0.5, 0, 1.5, 1)), (4, "GONE", square(5, 5, 6, 6)), (5, "GONE", square(5.4, 5, 6, 6)), (6, "SPLIT", square(8, 8, 9, 9)), (7, "MOVED", square(7, 7, 8, 8))]
    df = spark.createDataFrame([(i, c, [[(float(x), float(y)) for x, y in r]]) for i, c, r in shapes], f"shape_id int, code string, rings {RINGS}")
    current = spark.createDataFrame([("W", "lw"), ("E", "le"), ("OVER", "lo")], "code string, lg_code string")
    later = spark.createDataFrame([("SPLIT", "a"), ("SPLIT", "b"), ("SPLIT", "b"), ("MOVED", "m"), ("W", "never")], "code string, lg_code string")
    return df, current, later


def test_point_bridge_keeps_every_candidate(spark, world):
    points = spark.createDataFrame([("p1", 0.2, 0.5), ("p2", 0.7, 0.5), ("p3", 5.5, 5.5), ("p4", 8.5, 8.5), ("p5", 7.5, 7.5), ("p6", 99.0, 99.0), ("p7", None, None)], "id string, x double, y double")
    rows = {}
    for r in bridges.point_bridge(points, *world).collect():
        rows.setdefault(r.id, []).append(r)
    tell = lambda i: sorted((r.boundary_code, r.lg_code, r.relation_type, r.candidate_count, r.is_unique_match, r.verification_status, r.confidence) for r in rows[i])
    assert tell("p1") == [("W", "lw", "contains", 1, 1, "auto", 1.0)]
    assert tell("p2") == [("OVER", "lo", "ambiguous", 2, 0, "review_required", 1.0), ("W", "lw", "ambiguous", 2, 0, "review_required", 1.0)]
    assert tell("p3") == [("GONE", None, "contains", 1, 1, "review_required", 1.0)]
    assert tell("p4") == [("SPLIT", "a", "ambiguous", 2, 0, "review_required", 1.0), ("SPLIT", "b", "ambiguous", 2, 0, "review_required", 1.0)]
    assert tell("p5") == [("MOVED", "m", "contains", 1, 1, "auto", 1.0)] and rows["p5"][0].match_method == "spatial_containment_via_lineage" and rows["p5"][0].mismatch_note is None
    for p in ("p6", "p7"):
        assert [(r.boundary_code, r.relation_type, r.candidate_count, r.confidence) for r in rows[p]] == [(None, "unresolved", 0, 0.0)]
    assert "split" in rows["p4"][0].mismatch_note and "no current" in rows["p3"][0].mismatch_note
    gates.check_bridge(bridges.point_bridge(points, *world), ("unresolved", "spatial_containment", "spatial_containment_via_lineage"))


def test_station_and_line_bridges(spark, world):
    df = lines(spark, [(1, [[(0.1, 0.5), (0.3, 0.5)]]), (2, [[(8.1, 8.9), (8.1, 3.0), (8.9, 3.0), (8.9, 8.9)]]), (3, [[(50, 50), (51, 51)]])])
    rows = bridges.station_bridge(df, *world).collect()
    assert {(r.id, r.boundary_code, r.placement_point) for r in rows if r.id != 2} == {(1, "W", "centroid"), (3, None, None)}
    hits = bridges.line_bridge(df, *world, spacing=0.05).collect()
    assert {(r.id, r.boundary_code, r.relation_type, r.verification_status) for r in hits if r.id == 1} == {(1, "W", "overlap", "auto")}
    assert {r.municipality_count for r in hits if r.id == 2} == {2} and all(r.sample_hits > 0 for r in hits)


VERSION = "k string, payload string, ver_id string, observed_from string, observed_to string, is_current boolean"


def test_versions(spark):
    make = lambda rows: spark.createDataFrame(rows, VERSION)
    prev = make([("same", "a", "v1", "2026-08-01", None, True), ("changed", "a", "v2", "2026-09-20", None, True), ("gone", "a", "v3", "2026-08-01", None, True), ("old", "a", "v4", "2026-01-01", "2026-02-01", False), ("null", None, "v5", "2026-08-01", None, True)])
    stamp = "2026-09-17"
    cur = make([("same", "a", "w1", stamp, None, True), ("changed", "b", "w2", stamp, None, True), ("new", "a", "w3", stamp, None, True), ("null", "", "w5", stamp, None, True)])
    out = versioning.carry_forward(cur, prev, "k", "ver_id", stamp)
    found = {(r.k, r.ver_id): (r.observed_from, r.observed_to, r.is_current) for r in out.collect()}
    assert found[("changed", "v2")] == ("2026-09-20", "2026-09-20", False) and found[("changed", "w2")] == ("2026-09-20", None, True)
    assert found[("same", "v1")] == ("2026-08-01", None, True) and ("same", "w1") not in found
    assert found[("gone", "v3")] == ("2026-08-01", stamp, False) and found[("null", "v5")][2] is False and len(found) == 8
    again = versioning.carry_forward(cur, out, "k", "ver_id", stamp)
    assert again.count() == out.count()
    assert versioning.carry_forward(cur, None, "k", "ver_id", stamp).columns == cur.columns
    history = versioning.field_history(cur, prev, "k", ["payload"]).collect()
    assert [(r.k, r.field, r.old_value, r.new_value) for r in history] == [("changed", "payload", "a", "b")]
    assert versioning.field_history(cur, None, "k", ["payload"]).count() == 0


def test_identity_rules(spark):
    ledger = spark.createDataFrame([("e1", "A", "1", "one", True), ("e2", "A", "2", "two", True), ("e3", "A", "3", "three", True), ("e4", "A", "4", "twin", True), ("e5", "A", "5", "twin", True), ("e6", "B", "6", "six", True), ("e7", "A", "7", "seven", False), ("e8", "D", "8", "eight", True)], "entity_id string, area string, code string, name string, active boolean")
    towns = spark.createDataFrame([("A", "1", "one"), ("A", "2", "zwei"), ("A", "33", "three"), ("A", "44", "twin"), ("C", "6", "six"), ("A", "7", "seven"), ("A", "9", "nine"), ("E", "8", "eight")], "area string, code string, name string")
    recodes = spark.createDataFrame([("B", "C")], "old_area string, new_area string")
    out = versioning.resolve_identity(towns, ledger, recodes)
    found = {(r.area, r.code): (r.entity_id, r.rule, r.review) for r in out.collect()}
    assert found["A", "1"] == ("e1", "I1", None) and found["A", "2"] == ("e2", "I4", None) and found["A", "33"] == ("e3", "I2", None) and found["C", "6"] == ("e6", "I3", None)
    assert found["A", "44"][1:] == ("I5", "I2_ambiguous") and found["A", "7"][1:] == ("I6", "I6_reinstatement_candidate") and found["A", "9"][1:] == ("I5", None) and found["E", "8"][1:] == ("I5", "I3_unattested")
    assert versioning.collisions(out).count() == 0
    kept = {r.entity_id: r.active for r in versioning.retire(ledger, out).collect()}
    assert len(kept) == 8 and kept["e1"] and not kept["e4"]
    ids = spark.createDataFrame([("01", "1"), ("1", "01"), ("01", "1")], "a string, c string").select(versioning.mint("a", "c").alias("m")).collect()
    assert ids[0].m == ids[2].m != ids[1].m and len(ids[0].m) == 20


def test_an_id_goes_to_one_town(spark):
    ledger = spark.createDataFrame([("e1", "B", "1", "one", True), ("e2", "A", "2", "two", True), ("e3", "B", "3", "three", True), ("e4", "A", "5", "five", False), ("e5", "A", "5", "five", False), ("e6", "B", "6", "six", True)], "entity_id string, area string, code string, name string, active boolean")
    towns = spark.createDataFrame([("C1", "1", "one"), ("C2", "1", "one"), ("A", "22", "two"), ("D", "2", "two"), ("C1", "3", "drei"), ("A", "5", "five"), ("C1", "6", "six")], "area string, code string, name string")
    recodes = spark.createDataFrame([("B", "C1"), ("B", "C2"), ("A", "D")], "old_area string, new_area string")
    out = versioning.resolve_identity(towns, ledger, recodes)
    found = {(r.area, r.code): (r.entity_id, r.rule, r.review) for r in out.collect()}
    # a split recode, and an entity that a correction and a recode both claim
    assert found["C1", "1"][1:] == found["C2", "1"][1:] == ("I5", "I3_ambiguous") and found["A", "22"][1:] == ("I5", "I2_ambiguous") and found["D", "2"][1:] == ("I5", "I3_ambiguous")
    assert found["C1", "3"][1:] == ("I5", "I3_renamed") and found["C1", "6"] == ("e6", "I3", None)
    versioning.check_identity(out)
    # a key that comes back once more does not get the id that was retired after its last return
    again = found["A", "5"][0]
    once_more = ledger.unionByName(spark.createDataFrame([(again, "A", "5", "five", False)], ledger.schema))
    assert versioning.resolve_identity(towns, once_more, recodes).filter("code = '5'").first().entity_id not in (again, "e4", "e5")
    # an id that was given to a key whose town has moved on is not given again
    first = versioning.resolve_identity(towns.filter("code = '9'").unionByName(spark.createDataFrame([("Z", "9", "nine")], towns.schema)), ledger, recodes).first().entity_id
    moved = ledger.unionByName(spark.createDataFrame([(first, "Z", "10", "nine", True)], ledger.schema))
    both = versioning.resolve_identity(spark.createDataFrame([("Z", "10", "nine"), ("Z", "9", "neun")], towns.schema), moved, recodes)
    assert both.select("entity_id").distinct().count() == 2
    with pytest.raises(BuildError, match="IDENTITY_COLLISION"):
        versioning.check_identity(out.unionByName(out))
    lines = {(r.entity_id, r.relation_type) for r in versioning.identity_lineage(ledger, out).collect()}
    assert lines == {("e1", "retired"), ("e2", "retired"), ("e3", "retired"), ("e6", "municipality_recoded")}


def test_cascade_keeps_the_first_rule_that_matches(spark):
    entities = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id long, name string")
    rule = lambda n, rows: (f"R{n}", 1 / n, lambda e: e.join(spark.createDataFrame(rows, "id long, target string"), "id"), n < 3)
    out = bridges.cascade(entities, [rule(1, [(1, "x")]), rule(2, [(1, "y"), (2, "y"), (2, "z")]), rule(3, [(3, "w"), (2, "q")])])
    found = {(r.id, r.target, r.matching_rule_id, r.candidate_count, r.candidate_count_is_complete, r.relation_type) for r in out.collect()}
    assert found == {(1, "x", "R1", 1, True, "exact"), (2, "y", "R2", 2, True, "ambiguous"), (2, "z", "R2", 2, True, "ambiguous"), (3, "w", "R3", 1, False, "exact"), (4, None, "unresolved", 0, True, "unresolved")}
    many = bridges.cascade(entities, [rule(n, [(n, "x")]) for n in range(1, 12)])
    assert many.count() == 4 and many._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") < 80


def test_walk_ends(spark):
    edges = spark.createDataFrame([("a", "b", "2001", True), ("b", "a", "2002", True), ("b", "c", "2002", False), ("c", "c", "2003", True), ("a", "d", "2004", True)], "old string, new string, date string, is_unique boolean")
    roots = spark.createDataFrame([("a",), ("z",)], "code string")
    assert {tuple(r) for r in versioning.walk(roots, edges).collect()} == {("a", "c", "2002", False), ("a", "d", "2004", True), ("z", "z", "", True)}


def test_gates(spark):
    with pytest.raises(BuildError) as e:
        gates.validate_overrides([{"id": "x", "table": "t"}, {"id": "x", "table": "b", "where": {"a": 1}, "set": {"a": 2}, "decided_by": "p"}], {"b"})
    assert len(e.value.context["problems"]) == 5
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert {(r.k, r.v, r.surplus) for r in gates.multiset_differences(a, b).collect()} == {(1, "x", 1), (3, "y", -1)}
    assert gates.diff_keys(a, b, "k") == {"added": 0, "removed": 1, "added_sample": [], "removed_sample": [3]}
    with pytest.raises(BuildError):
        gates.check_unique(a, ["k"])
    with pytest.raises(BuildError):
        gates.check_reference(b, "k", a, "k")
    with pytest.raises(BuildError):
        gates.check_removals(spark.createDataFrame([(1,)], "unexplained int"))
    assert gates.coordinate_columns({"t": a.withColumnRenamed("v", "longitude"), "mlit_town_version": a.withColumnRenamed("v", "latitude")}) == ["t.longitude"]
    table, report = gates.apply_overrides(b.selectExpr("k", "v", "'auto' verification_status", "'R' matching_rule_id", "false override_stale"), [{"id": "1", "where": {"v": "x"}, "set": {"v": "z"}, "source_state": {"s": "1"}}, {"id": "2", "where": {"v": "z"}, "set": {"v": "w"}}], {"s": "1"})
    assert [r["rows"] for r in report] == [1, 1] and {(r.k, r.v, r.matching_rule_id, r.override_stale) for r in table.collect()} == {(1, "z", "manual_override", True), (2, None, "R", False), (3, "y", "R", False)}


def test_reconcile(spark):
    codes = lambda *x: spark.createDataFrame([(c,) for c in x], "code string")
    facts = {"parents": codes("14100"), "blank": codes("13199"), "unsurveyed": codes("01695"), "retired": spark.createDataFrame([("22131", "22138"), ("22135", "22138"), ("22135", "22139")], "old string, new string")}
    out = bridges.reconcile(codes("1", "22131", "22135", "13199", "99999"), codes("1", "14100", "01695", "22138", "77777"), facts)
    assert {r.code: r.status for r in out.collect()} == {"1": "matched", "14100": "designated_city_parent", "01695": "not_surveyed", "22131": "superseded", "22138": "successor", "22135": "split_no_single_successor", "13199": "unassigned_area", "99999": "left_only", "77777": "right_only"}


def test_numerals_and_names(spark):
    assert [normalize.numeral(x) for x in ("", "三", "十", "二十三", "百五", "〇", "一二", "十〇", "x", "二三十", None)] == [None, 3, 10, 23, 105, 0, 12, 10, None, 30, None]
    assert normalize.conservative("　三丁目　１－２ ") == "3丁目1-2" and normalize.conservative("三田") == "三田" and normalize.conservative("霞ヶ関") != normalize.conservative("霞が関")
    assert normalize.conservative("1ー2") == "1-2" and normalize.conservative("センター") == "センター"
    df = spark.createDataFrame([("大字字三田",), ("字本町（一部）",), (None,)], "n string")
    out = df.select(normalize.normalize_relaxed(df.n).alias("r"), normalize.normalize_postal_town(df.n).alias("p"), normalize.normalize_conservative(df.n).alias("c"))
    assert [tuple(r) for r in out.collect()] == [("字三田", "大字字三田", "大字字三田"), ("本町(一部)", "字本町", "字本町(一部)"), ("", "", "")]
    assert normalize.with_normalized(df, "n", "c").count() == 3


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("三十百丁目1２-ー‐ 　¨がカﾞ㌢ab\n") | st.characters(), max_size=12))
def test_normalising_twice_changes_nothing(text):
    once = normalize.conservative(text)
    assert normalize.conservative(once) == once


def test_meshes(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = [(rng.uniform(20, 46), rng.uniform(122, 154)) for _ in range(500)]
    df = spark.createDataFrame(rows, "lat double, lng double")
    out = df.select("lat", "lng", mesh.mesh3(df.lat, df.lng).alias("m3"), mesh.mesh6(df.lat, df.lng).alias("m6"), mesh.mesh2(df.lat, df.lng).alias("m2")).withColumn("p", mesh.parse_mesh(F.col("m6"))).collect()
    for r in out:
        assert r.m6.startswith(str(r.m3)) and str(r.m3).startswith(r.m2) and len(r.m6) == 11
        assert (r.p.row, r.p.col, r.p.span, r.p.level) == (math.floor(r.lat * 960), math.floor(r.lng * 640), 1, 6)
    bad = spark.createDataFrame([("5339",), ("53398999",), ("533945990",), (None,), ("53394599",)], "c string").select(mesh.parse_mesh(F.col("c")).alias("p")).collect()
    assert [r.p is None for r in bad] == [True, True, True, True, False] and bad[4].p.span == 8 and bad[4].p.level == 3
    assert mesh.meshes_in(35.60, 139.70, 35.75, 139.80, spark).count() == 6
    lng, lat = mesh.chunk_origin(F.col("k"))
    got = spark.createDataFrame([("all",), ("5339",), ("533945",)], "k string").select(lng.alias("x"), lat.alias("y")).collect()
    assert [tuple(r) for r in got] == [(122, 20), (139, 53 / 1.5), (139 + 5 / 8, 53 / 1.5 + 4 / 12)]


def test_runs(spark):
    runs = spark.createDataFrame([(10, 5, [1]), (15, 1, [1, 2]), (20, 1, [65535])], "start long, len long, ids array<int>")
    codes = spark.createDataFrame([(c,) for c in (9, 10, 14, 15, 16, 20)], "code long")
    assert {r.code: r.kind for r in mesh.run_lookup(codes, runs, 4).collect()} == {9: "none", 10: "contains", 14: "contains", 15: "ambiguous", 16: "none", 20: "unknown"}
    assert {(r.id, r.code) for r in mesh.cells_of(runs).collect()} >= {(2, 15), (1, 15), (1, 10)}


def test_chunks_come_back(spark):
    rng = random.Random(2)
    origin = (139.0, 35.0)
    ring = lambda n: [(139 + rng.random(), 35 + rng.random()) for _ in range(n)]
    cells = [(5339 * 10_000 + i, [(rng.randrange(2000), [ring(rng.randrange(3, 9)) for _ in range(2)]) for _ in range(2)]) for i in range(20)]
    back = geo_pack.unpack_cells(geo_pack.pack_cells(cells, origin), origin)
    assert [(c, [(u, len(r)) for u, r in p]) for c, p in back] == [(c, [(u, len(r)) for u, r in p]) for c, p in cells]
    worst = max(abs(a - b) for (_, p), (_, q) in zip(cells, back, strict=True) for (_, r), (_, s) in zip(p, q, strict=True) for x, y in zip(r, s, strict=True) for m, n in zip(x, y, strict=True) for a, b in zip(m, n, strict=True))
    assert worst <= 5.1e-7
    assert geo_pack.unpack_cells(geo_pack.pack_cells([(1, [(1, [[(139, 35)] * 5])]), (2, [])], origin), origin) == []
    assert geo_pack.unpack_lines(geo_pack.pack_lines([(7, [(139, 35), (139, 35), (139.5, 34.5)]), (8, [(139, 35)])], origin), origin) == [(7, [(139, 35), (139.5, 34.5)])]
    assert geo_pack.unvarints(geo_pack.varints([0, 127, 128, 300, 2**40])) == [0, 127, 128, 300, 2**40]
    df = spark.createDataFrame([("c", 139.0, 35.0, 5, 1, [[(139.0, 35.0), (139.1, 35.0), (139.1, 35.1)]]), ("c", 139.0, 35.0, 4, 1, [[(139.0, 35.0), (139.1, 35.0), (139.1, 35.1)]])], f"chunk string, ox double, oy double, code long, unit long, rings {RINGS}")
    (row,) = geo_pack.pack_chunks(df).collect()
    assert [c for c, _ in geo_pack.unpack_cells(bytes(row.data), origin)] == [4, 5]


def test_point_tables(spark):
    stations = spark.createDataFrame([("s1",), ("s2",)], "n02_group_code string")
    geometry = lines(spark, [(1, [[(139.0, 35.0), (139.2, 35.0), (139.2, 35.4)]])]).selectExpr("'s1' n02_group_code", "parts")
    bridge = spark.createDataFrame([("s1", "point_on_line"), ("s2", None)], "n02_group_code string, placement_point string")
    out = points.station_points(stations, geometry, bridge)
    assert {tuple(r) for r in out.collect()} == {("s1", 139.2, 35.1, "point_on_line"), ("s2", None, None, None)}
    points.check_points(out, stations, ["n02_group_code"], bridge)
    stops = points.stop_points(stations, spark.createDataFrame([("s2", 139.123456789, 35.0)], "n02_group_code string, x double, y double"), "n02_group_code")
    assert {tuple(r) for r in stops.collect()} == {("s1", None, None), ("s2", 139.123456789, 35.0)}
    swapped = out.selectExpr("n02_group_code", "latitude longitude", "longitude latitude", "placement_point")
    for bad in (swapped, out.limit(1), out.selectExpr("n02_group_code", "longitude", "latitude", "'centroid' placement_point")):
        with pytest.raises(BuildError):
            points.check_points(bad, stations, ["n02_group_code"], bridge)


def test_schools(spark):
    schools = spark.createDataFrame([("c1", "100", "本町一丁目5", "001", "c2; c9"), ("c2", "100", "本町9", "002", None), ("c3", "100", "山1", None, ""), ("c4", "200", "本町1", "001", None)], "school_code string, lg_code string, address string, postal_code string, successor_school_codes_raw string")
    towns = spark.createDataFrame([("a1", "100", "本町"), ("a2", "100", "本町一丁目"), ("a3", "100", "本町")], "address_id string, lg_code string, name string")
    postal = spark.createDataFrame([("a2", "001"), ("a1", "009")], "address_id string, postal_code string")
    found = {(r.school_code, r.address_id): (r.relation_type, r.postal_check) for r in points.school_bridge(schools, towns, postal).collect()}
    assert found == {("c1", "a2"): ("located_in", "matches"), ("c2", "a1"): ("ambiguous", "differs"), ("c2", "a3"): ("ambiguous", "differs"), ("c3", None): ("municipality_only", None), ("c4", None): ("municipality_only", None)}
    assert {tuple(r) for r in points.succession(schools).collect()} == {("c1", "c2", True), ("c1", "c9", False)}
    edges = points.lineage_edges(spark.createDataFrame([("1", "2", "2001", "x"), ("1", "3", "2001", "x"), ("4", "5", "2001", "x"), ("6", None, "2001", "x")], "old string, new string, date string, event_type string")).collect()
    assert {(r.old, r.new): (r.is_unique, r.parse_status) for r in edges} == {("1", "2"): (False, "parsed"), ("1", "3"): (False, "parsed"), ("4", "5"): (True, "parsed"), ("6", None): (False, "incomplete")}
