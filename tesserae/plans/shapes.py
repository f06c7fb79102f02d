"""Lines, meshes and text functions on the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mesh, normalize
from ..operators import bridges as B
from ..operators import spatial
from .inputs import SQL as INPUTS
from .inputs import current_codes, register, squares, successor_codes, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _lines(spark, d):
    """A line for each user: (seconds since 2024, value) of the events, in the order of time."""
    e = table(spark, d, "events").select(F.col("user_id").alias("id"), F.struct("ts", "event_id", ((F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200) / F.lit(1e4)).alias("x"), F.col("value").alias("y")).alias("p"))
    return e.groupBy("id").agg(F.array_sort(F.collect_list("p")).alias("ps")).select("id", F.array(F.transform("ps", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))).alias("parts"))


_LINES = """
    e AS (SELECT user_id AS id, ts, event_id, (epoch(date_trunc('second', ts)) - 1704067200) / CAST(10000 AS DOUBLE) AS x, value AS y FROM events),
    f AS (SELECT id, first(x ORDER BY ts, event_id) AS fx, first(y ORDER BY ts, event_id) AS fy FROM e GROUP BY id),
    seg AS (SELECT *, sqrt((qx - x) * (qx - x) + (qy - y) * (qy - y)) AS len FROM (
        SELECT id, ts, event_id, x, y, lead(x) OVER w AS qx, lead(y) OVER w AS qy FROM e WINDOW w AS (PARTITION BY id ORDER BY ts, event_id)) WHERE qx IS NOT NULL)
"""


@register(QUERIES, SQL, f"""WITH {_LINES}
    SELECT f.id, round(coalesce(sum((seg.x + qx) / 2 * len) / nullif(sum(len), 0), any_value(fx)), 3) AS x, round(coalesce(sum((seg.y + qy) / 2 * len) / nullif(sum(len), 0), any_value(fy)), 3) AS y
    FROM f LEFT JOIN seg ON f.id = seg.id GROUP BY f.id""")
def line_centroid(spark, d):
    return spatial.line_centroid(_lines(spark, d)).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@register(QUERIES, SQL, f"""WITH {_LINES},
    walked AS (SELECT *, sum(len) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS upto, sum(len) OVER (PARTITION BY id) AS total FROM seg),
    got AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS n FROM walked WHERE total > 0 AND upto >= total / 2)
    SELECT f.id, round(coalesce(g.x + (g.qx - g.x) * (g.total / 2 - (g.upto - g.len)) / nullif(g.len, 0), fx), 3) AS x, round(coalesce(g.y + (g.qy - g.y) * (g.total / 2 - (g.upto - g.len)) / nullif(g.len, 0), fy), 3) AS y
    FROM f LEFT JOIN got g ON f.id = g.id AND g.n = 1""")
def point_on_line(spark, d):
    return spatial.point_on_line(_lines(spark, d)).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


_WIDE = f"""{INPUTS},
    e AS (SELECT user_id AS id, ts, event_id, (epoch(date_trunc('second', ts)) - 1704067200) / CAST(10000 AS DOUBLE) * 150 AS x, value / 4 AS y FROM events),
    f AS (SELECT id, first(x ORDER BY ts, event_id) AS fx, first(y ORDER BY ts, event_id) AS fy FROM e GROUP BY id),
    seg AS (SELECT *, sqrt((qx - x) * (qx - x) + (qy - y) * (qy - y)) AS len FROM (
        SELECT id, ts, event_id, x, y, lead(x) OVER w AS qx, lead(y) OVER w AS qy FROM e WINDOW w AS (PARTITION BY id ORDER BY ts, event_id)) WHERE qx IS NOT NULL)"""
_INSIDE = "{0}.x >= b.x0 AND {0}.x < b.x1 AND {0}.y >= 0 AND {0}.y < 40"


def _wide(spark, d):
    """Lines scaled into the polygons' plane."""
    return _lines(spark, d).select("id", F.transform("parts", lambda p: F.transform(p, lambda q: F.struct((q["x"] * 150).alias("x"), (q["y"] / 4).alias("y")))).alias("parts"))


@register(QUERIES, SQL, f"""WITH {_WIDE},
    centre AS (SELECT f.id, coalesce(sum((seg.x + qx) / 2 * len) / nullif(sum(len), 0), any_value(fx)) AS x, coalesce(sum((seg.y + qy) / 2 * len) / nullif(sum(len), 0), any_value(fy)) AS y FROM f LEFT JOIN seg ON f.id = seg.id GROUP BY f.id),
    walked AS (SELECT *, sum(len) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS upto, sum(len) OVER (PARTITION BY id) AS total FROM seg),
    got AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS n FROM walked WHERE total > 0 AND upto >= total / 2),
    half AS (SELECT f.id, coalesce(g.x + (g.qx - g.x) * (g.total / 2 - (g.upto - g.len)) / nullif(g.len, 0), fx) AS x, coalesce(g.y + (g.qy - g.y) * (g.total / 2 - (g.upto - g.len)) / nullif(g.len, 0), fy) AS y FROM f LEFT JOIN got g ON f.id = g.id AND g.n = 1),
    by_centre AS (SELECT c.id, b.code, 'centroid' AS placed FROM centre c JOIN boxes b ON {_INSIDE.format('c')}),
    placed AS (SELECT * FROM by_centre UNION ALL SELECT h.id, b.code, 'point_on_line' FROM half h JOIN boxes b ON {_INSIDE.format('h')} WHERE h.id NOT IN (SELECT id FROM by_centre)),
    r AS (SELECT f.id, p.placed, m.code, m.lg_code, coalesce(m.via, false) AS via, CASE WHEN m.code IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY f.id) END AS n FROM f LEFT JOIN placed p ON f.id = p.id LEFT JOIN meant m ON p.code = m.code)
    SELECT id, placed AS placement_point, lg_code, code AS boundary_code, n AS candidate_count, CASE WHEN code IS NULL THEN 'unresolved' WHEN n = 1 THEN 'contains' ELSE 'ambiguous' END AS relation_type,
           CASE WHEN code IS NULL THEN 'unresolved' WHEN via THEN 'spatial_containment_via_lineage' ELSE 'spatial_containment' END AS match_method, CASE WHEN code IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS confidence,
           CAST(CASE WHEN n = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_unique_match, CASE WHEN n = 1 AND lg_code IS NOT NULL THEN 'auto' ELSE 'review_required' END AS verification_status,
           CASE WHEN code IS NULL THEN 'in no polygon; not assigned to the nearest one' WHEN via AND lg_code IS NOT NULL AND n <> 1 THEN 'code ' || code || ' was split; ' || lg_code || ' is one of its successors'
                WHEN lg_code IS NULL THEN 'code ' || code || ' has no current counterpart' WHEN n <> 1 THEN 'in several polygons; all candidates are kept' END AS mismatch_note FROM r""")
def station_bridge(spark, d):
    """Lines placed by centroid or halfway point."""
    return B.station_bridge(_wide(spark, d), squares(spark, d), current_codes(spark, d), successor_codes(spark, d), cell=(2500.0, 20.0))


@register(QUERIES, SQL, f"""WITH {_WIDE},
    cut AS (SELECT *, greatest(1, CAST(ceil(len / 500) AS INTEGER)) AS n FROM seg), steps AS (SELECT *, unnest(range(0, n + 1)) AS k FROM cut),
    samples AS (SELECT id, x + (qx - x) * (k / CAST(n AS DOUBLE)) AS x, y + (qy - y) * (k / CAST(n AS DOUBLE)) AS y FROM steps),
    touched AS (SELECT s.id, b.code, count(*) AS sample_hits FROM samples s JOIN boxes b ON {_INSIDE.format('s')} GROUP BY s.id, b.code),
    r AS (SELECT t.id, t.code, sample_hits, m.lg_code, m.via, count(*) OVER (PARTITION BY t.id) AS municipality_count FROM touched t JOIN (SELECT DISTINCT code, lg_code, via FROM meant) m ON t.code = m.code)
    SELECT id, code AS boundary_code, sample_hits, lg_code, municipality_count, 'overlap' AS relation_type, CASE WHEN via THEN 'spatial_sampling_via_lineage' ELSE 'spatial_sampling' END AS match_method,
           CASE WHEN lg_code IS NULL THEN 'review_required' ELSE 'auto' END AS verification_status, CASE WHEN lg_code IS NULL THEN 'code ' || code || ' has no current counterpart' END AS mismatch_note FROM r""")
def line_bridge(spark, d):
    return B.line_bridge(_wide(spark, d), squares(spark, d), current_codes(spark, d), successor_codes(spark, d), spacing=500.0, cell=(2500.0, 20.0))


_LAT, _LNG = "(20 + (c_custkey % 2500) / CAST(100 AS DOUBLE))", "(122 + (c_custkey * 7 % 3100) / CAST(100 AS DOUBLE))"
_PLACES = f"SELECT c_custkey AS id, {_LAT} AS lat, {_LNG} AS lng FROM customer"
_CODE3 = "(row_ // 80) * 1000000 + (col // 80 - 100) * 10000 + (row_ % 80 // 10) * 1000 + (col % 80 // 10) * 100 + row_ % 10 * 10 + col % 10"


def _places(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 2500 / F.lit(100.0) + 20).alias("lat"), (F.col("c_custkey") * 7 % 3100 / F.lit(100.0) + 122).alias("lng"))


@register(QUERIES, SQL, f"""WITH p AS ({_PLACES}), q AS (SELECT id, CAST(floor(lat * 120) AS BIGINT) AS row_, CAST(floor(lng * 80) AS BIGINT) AS col, CAST(floor(lat * 12) AS BIGINT) AS r2, CAST(floor(lng * 8) AS BIGINT) AS c2 FROM p)
    SELECT id, {_CODE3} AS mesh3, lpad(CAST(r2 // 8 AS VARCHAR), 2, '0') || lpad(CAST(c2 // 8 - 100 AS VARCHAR), 2, '0') || (r2 % 8) || (c2 % 8) AS mesh2 FROM q""")
def mesh_code(spark, d):
    return _places(spark, d).select("id", mesh.mesh3(F.col("lat"), F.col("lng")).alias("mesh3"), mesh.mesh2(F.col("lat"), F.col("lng")).alias("mesh2"))


@register(QUERIES, SQL, f"""WITH p AS ({_PLACES}), s AS (SELECT id, CAST(floor(lat * 960) AS BIGINT) AS r6, CAST(floor(lng * 640) AS BIGINT) AS c6 FROM p), q AS (SELECT *, r6 // 8 AS row_, c6 // 8 AS col FROM s)
    SELECT id, lpad(CAST({_CODE3} AS VARCHAR), 8, '0') || (1 + c6 // 4 % 2 + 2 * (r6 // 4 % 2)) || (1 + c6 // 2 % 2 + 2 * (r6 // 2 % 2)) || (1 + c6 % 2 + 2 * (r6 % 2)) AS mesh6, r6 AS row_back, c6 AS col_back FROM q""")
def mesh6_code(spark, d):
    p = _places(spark, d).select("id", mesh.mesh6(F.col("lat"), F.col("lng")).alias("mesh6")).withColumn("m", mesh.parse_mesh(F.col("mesh6")))
    return p.select("id", "mesh6", F.col("m.row").alias("row_back"), F.col("m.col").alias("col_back"))


@register(QUERIES, SQL, """
    WITH runs AS (SELECT p_partkey * 50 AS start, 10 + p_size % 30 AS len, p_partkey % 4 AS k FROM part),
    codes AS (SELECT DISTINCT o_orderkey * 3 AS code FROM orders)
    SELECT code, CASE WHEN k IS NULL THEN 'none' WHEN k = 1 THEN 'ambiguous' WHEN k = 2 THEN 'unknown' ELSE 'contains' END AS kind
    FROM codes LEFT JOIN runs ON code >= start AND code < start + len""")
def mesh_run_lookup(spark, d):
    """A run for each part, a code for each order."""
    runs = table(spark, d, "part").selectExpr("p_partkey * 50 AS start", "cast(10 + p_size % 30 AS long) AS len", "CASE p_partkey % 4 WHEN 1 THEN array(1, 2) WHEN 2 THEN array(65535) ELSE array(7) END AS ids")
    codes = table(spark, d, "orders").selectExpr("o_orderkey * 3 AS code").distinct()
    return mesh.run_lookup(codes, runs).select("code", "kind")


#: A slanted ring with a hole for each supplier, by offsets from its corner (degrees).
_OUTER, _HOLE = ((0.0013, 0.0021), (0.0587, 0.0107), (0.0471, 0.0433), (0.0119, 0.0391)), ((0.0205, 0.0153), (0.0347, 0.0171), (0.0301, 0.0305))
_LNG0, _LAT0 = "130 + (s_suppkey * 37 % 97) * 0.0231::DOUBLE", "33 + (s_suppkey * 53 % 89) * 0.0137::DOUBLE"


def _plots(spark, d):
    k = F.col("s_suppkey")
    x, y = F.lit(130) + k * 37 % 97 * F.lit(0.0231), F.lit(33) + k * 53 % 89 * F.lit(0.0137)
    ring = lambda corners: F.array(*[F.struct((x + F.lit(dx)).alias("x"), (y + F.lit(dy)).alias("y")) for dx, dy in corners])
    return table(spark, d, "supplier").select(k.alias("id"), F.array(ring(_OUTER), ring(_HOLE)).alias("rings"))


def _edge_list() -> str:
    return ", ".join(f"({r[i - 1][0]}::DOUBLE, {r[i - 1][1]}::DOUBLE, {r[i][0]}::DOUBLE, {r[i][1]}::DOUBLE)" for r in (_OUTER, _HOLE) for i in range(len(r)))


#: Every square around every shape, classified: touched by an edge, or inside by its middle.
_SQUARES = f"""
    plots AS (SELECT s_suppkey AS id, {_LNG0} AS x0, {_LAT0} AS y0 FROM supplier),
    edges AS (SELECT id, (x0 + e.a) * 640 AS px, (y0 + e.b) * 960 AS py, (x0 + e.c) * 640 AS qx, (y0 + e.d) * 960 AS qy FROM plots, (VALUES {_edge_list()}) e(a, b, c, d)),
    extent AS (SELECT id, CAST(floor(min(least(px, qx))) AS BIGINT) - 1 AS c0, CAST(floor(max(greatest(px, qx))) AS BIGINT) + 1 AS c1, CAST(floor(min(least(py, qy))) AS BIGINT) - 1 AS r0,
                      CAST(floor(max(greatest(py, qy))) AS BIGINT) + 1 AS r1 FROM edges GROUP BY id),
    squares AS (SELECT id, r, unnest(range(c0, c1 + 1)) AS c FROM (SELECT *, unnest(range(r0, r1 + 1)) AS r FROM extent)),
    tested AS (
        SELECT s.id, s.r, s.c, bool_or(floor(least(py, qy)) <= r AND floor(greatest(py, qy)) >= r
                AND floor(least(px + (greatest(least(py, qy), r) - py) * (qx - px) / (qy - py), px + (least(greatest(py, qy), r + 1) - py) * (qx - px) / (qy - py)) - 1e-8) <= c
                AND floor(greatest(px + (greatest(least(py, qy), r) - py) * (qx - px) / (qy - py), px + (least(greatest(py, qy), r + 1) - py) * (qx - px) / (qy - py)) + 1e-8) >= c) AS touched,
            count(*) FILTER (WHERE (py > r + 0.5) <> (qy > r + 0.5) AND c + 0.5 < px + (r + 0.5 - py) * (qx - px) / (qy - py)) % 2 = 1 AS inside
        FROM squares s JOIN edges e ON s.id = e.id GROUP BY s.id, s.r, s.c),
    reached AS (
        SELECT (((r // 640) * 1000000 + (c // 640 - 100) * 10000 + (r // 8 % 80 // 10) * 1000 + (c // 8 % 80 // 10) * 100 + r // 8 % 10 * 10 + c // 8 % 10) * 64
                + (c // 4 % 2 + 2 * (r // 4 % 2)) * 16 + (c // 2 % 2 + 2 * (r // 2 % 2)) * 4 + c % 2 + 2 * (r % 2)) AS n, id, touched FROM tested WHERE touched OR inside)"""


@register(QUERIES, SQL, f"""WITH {_SQUARES},
    squares_of AS (SELECT n, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids, count(*) = 1 AND NOT bool_or(touched) AS uniform FROM reached GROUP BY n),
    islands AS (SELECT *, n - row_number() OVER (PARTITION BY ids, uniform ORDER BY n) AS island FROM squares_of)
    SELECT min(n) AS start, count(*) AS len, ids, uniform FROM islands GROUP BY ids, uniform, island""")
def mesh_runs_build(spark, d):
    """Sixth-order squares that the suppliers' plots reach, as runs."""
    runs = mesh.build_runs(_plots(spark, d), level=6)
    return runs.select("start", "len", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"), "uniform")


@register(QUERIES, SQL, f"""WITH {_SQUARES}, squares_of AS (SELECT n, count(*) AS k, min(id) AS id FROM reached GROUP BY n),
    places AS (SELECT c_custkey, CAST(floor((130 + (c_custkey * 11 % 2300) * 0.001::DOUBLE) * 640) AS BIGINT) AS c, CAST(floor((33 + (c_custkey * 13 % 1250) * 0.001::DOUBLE) * 960) AS BIGINT) AS r FROM customer),
    numbered AS (SELECT c_custkey, (((r // 640) * 1000000 + (c // 640 - 100) * 10000 + (r // 8 % 80 // 10) * 1000 + (c // 8 % 80 // 10) * 100 + r // 8 % 10 * 10 + c // 8 % 10) * 64
                + (c // 4 % 2 + 2 * (r // 4 % 2)) * 16 + (c // 2 % 2 + 2 * (r // 2 % 2)) * 4 + c % 2 + 2 * (r % 2)) AS n FROM places)
    SELECT c_custkey, CASE WHEN k IS NULL THEN 'none' WHEN k = 1 THEN 'contains' ELSE 'ambiguous' END AS kind, CASE WHEN k = 1 THEN id END AS id FROM numbered LEFT JOIN squares_of USING (n)""")
def mesh_runs_lookup(spark, d):
    """Customers at places, looked up in the runs of the plots."""
    k = F.col("c_custkey")
    c = F.floor((F.lit(130) + k * 11 % 2300 * F.lit(0.001)) * 640).cast("long")
    r = F.floor((F.lit(33) + k * 13 % 1250 * F.lit(0.001)) * 960).cast("long")
    places = table(spark, d, "customer").select("c_custkey", mesh.square_number(r, c, 6).alias("code"))
    found = mesh.run_lookup(places, mesh.build_runs(_plots(spark, d), level=6))
    return found.select("c_custkey", "kind", F.when(F.col("kind") == "contains", F.element_at("ids", 1)).alias("id"))


_SLANTED = "(5 + 20 * n_nationkey % 140)"


@register(QUERIES, SQL, f"""
    WITH shapes AS (SELECT n_nationkey AS shape_id, CAST(600 * n_nationkey AS DOUBLE) AS cx, CAST({_SLANTED} AS DOUBLE) AS half FROM nation),
    corners AS (  -- a kite with a slanted hole: each edge from (ax, ay) to (bx, by)
        SELECT shape_id, unnest([cx, cx + 2500, cx + 300, cx - 900, cx, cx + 700, cx + 100]) AS ax, unnest([25 - half / 10, 25, 25 + half / 7, 24, 25 - half / 30, 25.5, 25 + half / 40]) AS ay,
               unnest([cx + 2500, cx + 300, cx - 900, cx, cx + 700, cx + 100, cx]) AS bx, unnest([25, 25 + half / 7, 24, 25 - half / 10, 25.5, 25 + half / 40, 25 - half / 30]) AS by FROM shapes),
    points AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice AS x, l_quantity + l_discount AS y FROM lineitem)
    SELECT shape_id, count(*) AS n_points, CAST(sum(l_linenumber) AS BIGINT) AS n_lines FROM (
        SELECT p.l_orderkey, p.l_partkey, p.l_suppkey, p.l_linenumber, c.shape_id FROM points p JOIN corners c ON (c.ay > p.y) <> (c.by > p.y) AND p.x < c.ax + (p.y - c.ay) * (c.bx - c.ax) / nullif(c.by - c.ay, 0)
        GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY shape_id""")
def slanted_shapes(spark, d):
    """Points in kites with slanted holes."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("shape_id"), (F.lit(600.0) * F.col("n_nationkey")).alias("cx"), (5 + 20 * F.col("n_nationkey") % 140).cast("double").alias("half"))
    at = lambda dx, y: F.struct((F.col("cx") + float(dx)).alias("x"), y.cast("double").alias("y"))
    half = F.col("half")
    kite = F.array(at(0, 25 - half / 10), at(2500, F.lit(25.0)), at(300, 25 + half / 7), at(-900, F.lit(24.0)))
    hole = F.array(at(0, 25 - half / 30), at(700, F.lit(25.5)), at(100, 25 + half / 40))
    shapes = n.select("shape_id", F.col("shape_id").cast("string").alias("code"), F.array(kite, hole).alias("rings"))
    points = table(spark, d, "lineitem").select("l_linenumber", F.col("l_extendedprice").alias("x"), (F.col("l_quantity") + F.col("l_discount")).alias("y"))
    hits = spatial.containment_join(points, shapes, (500.0, 2.0))
    return hits.groupBy(F.col("code").cast("int").alias("shape_id")).agg(F.count("*").alias("n_points"), F.sum("l_linenumber").alias("n_lines"))


@register(QUERIES, SQL, """SELECT station, line, operator, count(*) AS n_features, count(DISTINCT name) AS name_variants, min(name) AS name FROM (
    SELECT l_suppkey AS station, l_partkey % 20 AS line, l_linenumber AS operator, l_shipdate::DATE::VARCHAR AS name FROM lineitem) f GROUP BY station, line, operator""")
def station_lines(spark, d):
    features = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("station"), (F.col("l_partkey") % 20).alias("line"), F.col("l_linenumber").alias("operator"), F.col("l_shipdate").cast("date").cast("string").alias("name"))
    return B.station_lines(features)


@register(QUERIES, SQL)
def normalize_text(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.sha2(normalize.normalize_conservative(F.col("text")), 256).alias("normal_sha256"))


@register(QUERIES, SQL, r"""SELECT page_id, sha256(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '<[^>]*>', '', 'g'), '[ \t\n\r\f\x0b]+', '', 'g')) AS text_hash FROM pages""")
def license_text_hash(spark, d):
    return table(spark, d, "pages").select("page_id", normalize.license_text_hash(F.col("html")).alias("text_hash"))


@register(QUERIES, SQL, """SELECT arg_max(s, t) AS stamp FROM (SELECT CASE WHEN event_id % 5 = 0 THEN 'last tuesday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS s, CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS t
    FROM events WHERE event_id % 7 <> 0) WHERE t IS NOT NULL""")
def acquisition_stamp(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, "last tuesday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("s"))
    return normalize.acquisition_stamp(e, "s", "event_id % 7 <> 0")


@register(QUERIES, SQL, """SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'no_listing' WHEN p_name LIKE '%e' THEN 'ends_e' WHEN p_name LIKE '%d' THEN 'ends_d' ELSE 'town' END AS kind,
    rtrim(rpad(p_brand, 20, ' '), ' ') AS brand FROM part""")
def suffix_classifier(spark, d):
    """An ordered classifier by suffixes, and right-padding taken off (only on the right, only blanks)."""
    name = F.when(F.col("p_partkey") % 11 != 0, F.col("p_name"))
    kind = F.when(name.isNull(), "no_listing").when(name.endswith("e"), "ends_e").when(name.endswith("d"), "ends_d").otherwise("town")
    return table(spark, d, "part").select("p_partkey", kind.alias("kind"), F.rtrim(F.rpad("p_brand", 20, " ")).alias("brand"))
