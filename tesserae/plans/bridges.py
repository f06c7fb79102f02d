"""Bridges and lineage on the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..durable import durable
from ..operators import bridges as B
from ..operators import matching, spatial, versioning
from .inputs import CELL, SQL as INPUTS, current_codes, register, squares, stops, successor_codes, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _bridge(spark, d):
    return B.point_bridge(stops(spark, d), squares(spark, d), current_codes(spark, d), successor_codes(spark, d), cell=CELL)


@register(QUERIES, SQL, f"""WITH {INPUTS}
    SELECT coalesce(lg_code, '-') AS lg_code, relation_type, match_method, verification_status, count(*) AS n_rows, count(DISTINCT id) AS n_points,
           count(DISTINCT CASE WHEN is_unique_match = 1 THEN id END) AS n_settled,
           round(100.0 * count(DISTINCT CASE WHEN is_unique_match = 1 THEN id END) / nullif(count(DISTINCT id), 0), 1)::DOUBLE AS pct_settled
    FROM bridge GROUP BY ALL""")
def bridge_point_polygon(spark, d):
    """Flagship: points into polygons, codes read through lineage, all candidates kept, then summed up by municipality."""
    groups = [F.coalesce("lg_code", F.lit("-")).alias("lg_code"), "relation_type", "match_method", "verification_status"]
    # the rows of a point lie together already: each point is summed up where it is, and no ids are sent
    points = _bridge(spark, d).groupBy(*groups, "id").agg(F.count("*").alias("n"), F.max("is_unique_match").alias("settled"))
    sums = points.groupBy("lg_code", "relation_type", "match_method", "verification_status").agg(
        F.sum("n").alias("n_rows"), F.count("id").alias("n_points"), F.count_if(F.col("id").isNotNull() & (F.col("settled") == 1)).alias("n_settled")
    )
    return sums.withColumn("pct_settled", F.round(F.try_divide(F.col("n_settled") * 100.0, F.col("n_points")), 1))


@register(QUERIES, SQL, f"WITH {INPUTS} SELECT id, name, lg_code, boundary_code, candidate_count, relation_type, match_method, confidence, is_unique_match, verification_status, mismatch_note FROM bridge")
def bridge_rows(spark, d):
    return _bridge(spark, d)


@register(QUERIES, SQL, f"WITH {INPUTS} SELECT s.id, b.code FROM stops s JOIN boxes b ON s.x BETWEEN b.x0 AND b.x1 AND s.y BETWEEN 0 AND 40")
def grid_candidates(spark, d):
    boxes = spatial.with_box(squares(spark, d)).select("code", "x0", "y0", "x1", "y1")
    return spatial.grid_candidates(stops(spark, d), boxes, CELL).select("id", "code")


@register(QUERIES, SQL, f"WITH {INPUTS} SELECT DISTINCT code, lg_code, via AS via_lineage FROM meant")
def lineage_resolve(spark, d):
    return B.resolve_codes(squares(spark, d), current_codes(spark, d), successor_codes(spark, d))


_EDGES = "SELECT CAST(p_partkey AS VARCHAR) AS old, CAST((7 * p_partkey + 3) % (SELECT max(p_partkey) + 1 FROM part) AS VARCHAR) AS new, lpad(CAST(p_size AS VARCHAR), 3, '0') AS date, p_partkey % 3 <> 0 AS is_unique FROM part"


@register(QUERIES, SQL, f"""WITH RECURSIVE edges AS ({_EDGES}),
    w AS (
        SELECT old AS root, old AS code, '' AS since, true AS all_unique FROM edges
        UNION SELECT w.root, e.new, e.date, w.all_unique AND e.is_unique FROM w JOIN edges e ON w.code = e.old AND e.date > w.since AND e.old <> e.new
    )
    SELECT root, code, since, all_unique FROM w WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.old = w.code AND e.date > w.since AND e.old <> e.new)""")
def lineage_walk(spark, d):
    """An edge for each part, a walk from each."""
    p = table(spark, d, "part")
    codes = (p.agg(F.max("p_partkey")).first()[0] or 0) + 1
    edges = p.select(F.col("p_partkey").cast("string").alias("old"), ((F.col("p_partkey") * 7 + 3) % codes).cast("string").alias("new"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("date"), (F.col("p_partkey") % 3 != 0).alias("is_unique"))
    return versioning.walk(edges.select(F.col("old").alias("code")), edges)


@register(QUERIES, SQL, """
    WITH l AS (SELECT s_suppkey AS code FROM supplier WHERE s_suppkey % 3 <> 0), r AS (SELECT s_suppkey AS code FROM supplier WHERE s_suppkey % 4 <> 0),
    retired AS (SELECT s_suppkey AS old, s_suppkey + 3 AS new FROM supplier WHERE s_suppkey % 8 = 0 UNION ALL SELECT s_suppkey, s_suppkey + 6 FROM supplier WHERE s_suppkey % 16 = 0),
    j AS (SELECT coalesce(l.code, r.code) AS code, l.code IS NOT NULL AS in_left, r.code IS NOT NULL AS in_right FROM l FULL JOIN r ON l.code = r.code)
    SELECT code, in_left, in_right, CASE WHEN in_left AND in_right THEN 'matched' WHEN in_right AND code % 27 = 0 THEN 'designated_city_parent'
        WHEN in_right AND code IN (SELECT new FROM retired) THEN 'successor' WHEN in_right AND code % 5 = 0 THEN 'not_surveyed' WHEN in_right THEN 'right_only'
        WHEN code % 20 = 0 THEN 'unassigned_area' WHEN (SELECT count(DISTINCT new) FROM retired WHERE old = j.code) = 1 THEN 'superseded'
        WHEN (SELECT count(DISTINCT new) FROM retired WHERE old = j.code) > 1 THEN 'split_no_single_successor' ELSE 'left_only' END AS status FROM j""")
def reconcile_status(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("code"))
    retired = s.filter("code % 8 = 0").select(F.col("code").alias("old"), (F.col("code") + 3).alias("new")).unionByName(s.filter("code % 16 = 0").select(F.col("code").alias("old"), (F.col("code") + 6).alias("new")))
    facts = {"parents": s.filter("code % 27 = 0"), "blank": s.filter("code % 20 = 0"), "unsurveyed": s.filter("code % 5 = 0"), "retired": retired}
    return B.reconcile(s.filter("code % 3 <> 0"), s.filter("code % 4 <> 0"), facts)


_TARGETS = """SELECT CASE WHEN p_partkey % 7 = 0 THEN p_partkey ELSE -1 - p_partkey END AS k, CAST(p_partkey AS VARCHAR) AS target, CASE WHEN p_partkey % 3 = 0 THEN p_name || '*' ELSE p_name END AS name, p_brand, p_size FROM part"""


@register(QUERIES, SQL, f"""
    WITH e AS (SELECT p_partkey AS id, p_name AS name, p_brand, p_size FROM part), t AS ({_TARGETS}),
    m1 AS (SELECT e.id, t.target, 'R1' AS rule, 1.0 AS conf, true AS whole FROM e JOIN t ON e.id = t.k),
    m2 AS (SELECT DISTINCT e.id, t.target, 'R2' AS rule, 0.8 AS conf, true AS whole FROM e JOIN t ON e.name = t.name AND e.p_brand = t.p_brand AND e.p_size = t.p_size WHERE e.id NOT IN (SELECT id FROM m1)),
    m3 AS (SELECT DISTINCT e.id, t.target, 'R3' AS rule, 0.5 AS conf, false AS whole FROM e JOIN t ON e.name || '*' = t.name AND e.p_brand = t.p_brand WHERE e.id NOT IN (SELECT id FROM m1) AND e.id NOT IN (SELECT id FROM m2)),
    u AS (SELECT e.id, NULL AS target, 'unresolved' AS rule, 0.0 AS conf, true AS whole FROM e WHERE id NOT IN (SELECT id FROM m1) AND id NOT IN (SELECT id FROM m2) AND id NOT IN (SELECT id FROM m3)),
    a AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3 UNION ALL SELECT * FROM u),
    n AS (SELECT *, count(target) OVER (PARTITION BY id) AS c FROM a)
    SELECT id, target, rule AS matching_rule_id, CAST(conf AS DOUBLE) AS confidence, 'grp_' || substr(sha256(CAST(id AS VARCHAR)), 1, 16) AS candidate_group_id, c AS candidate_count, whole AS candidate_count_is_complete,
           c = 1 AS is_unique_match, CASE WHEN c = 0 THEN 'unresolved' WHEN c = 1 THEN 'exact' ELSE 'ambiguous' END AS relation_type, CASE WHEN c = 1 THEN 'auto' ELSE 'review_required' END AS verification_status FROM n""")
def rule_cascade(spark, d):
    """Every part as an entity and as a target; some targets have another key or another name, so that each rule finds its own."""
    part, k = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), "p_brand", "p_size"), F.col("p_partkey")
    other = F.concat("name", F.lit("*"))
    t = part.select(F.when(k % 7 == 0, k).otherwise(-1 - k).alias("k"), k.cast("string").alias("target"), F.when(k % 3 == 0, other).otherwise(F.col("name")).alias("name"), "p_brand", "p_size")
    columns = lambda *names: {c: F.col(c) for c in names}
    by_key = B.By({"k": F.col("id")}, t.select("k", "target"))
    by_name = B.By(columns("name", "p_brand", "p_size"), t.drop("k"))
    by_part = B.By({"name": other} | columns("p_brand"), t.drop("k", "p_size"))
    return B.cascade(part.withColumnRenamed("p_partkey", "id"), [("R1", 1.0, by_key), ("R2", 0.8, by_name), ("R3", 0.5, by_part, False)])


#: Coverage texts, by the customer's number: brackets of up to three levels, limits and exceptions.
_BRACKETS = ("", "（東区、西区に限る。）", "（東区を除く。）", "（北区、東区（一部、二部を除く）を除く）", "（東区（一部（甲、乙に限る）、二部を除く）に限る）", "（旧）", "(南区(三部に限る)、北区を除く)")
_AREAS = "SELECT c_custkey AS code, CASE WHEN c_custkey % 3 = 0 THEN 'A県' ELSE '' END || 'c' || c_custkey // 30 || '市' || CASE c_custkey % 7 {} END || '、d' || c_custkey // 20 || '町' || CASE WHEN c_custkey % 4 = 0 THEN '、somewhere' ELSE '' END AS t FROM customer".format(
    " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(_BRACKETS))
)


def _areas(spark, d):
    k = F.col("c_custkey")
    bracket = F.element_at(F.array(*map(F.lit, _BRACKETS)), (k % len(_BRACKETS)).cast("int") + 1)
    number = lambda n: F.floor(k / n).cast("string")
    text = F.concat(F.when(k % 3 == 0, "A県").otherwise(""), F.lit("c"), number(30), F.lit("市"), bracket, F.lit("、d"), number(20), F.lit("町"), F.when(k % 4 == 0, "、somewhere").otherwise(""))
    return table(spark, d, "customer").select(k.alias("area_code"), text.alias("area_text"))


#: A walk over the tokens, one a step, and the names with what their brackets do.
_TREE = f"""
    areas AS ({_AREAS}), toks AS (SELECT code, regexp_extract_all(t, '[（(]|[）)]|、|[^（(）)、]+') AS ts FROM areas),
    walk AS (
        SELECT code, ts, 0 AS i, CAST([] AS INTEGER[]) AS stack, 0 AS item, 0 AS n, 0 AS node, 0 AS parent, 0 AS depth, CAST(NULL AS VARCHAR) AS word FROM toks
        UNION ALL
        SELECT code, ts, i + 1, CASE WHEN ts[i + 1] IN ('（', '(') THEN list_append(stack, item) WHEN ts[i + 1] IN ('）', ')') THEN stack[:-2] ELSE stack END,
            CASE WHEN ts[i + 1] IN ('（', '(', '、') THEN 0 WHEN ts[i + 1] IN ('）', ')') THEN stack[-1] WHEN item = 0 THEN n + 1 ELSE item END,
            CASE WHEN item = 0 AND ts[i + 1] NOT IN ('（', '(', '、', '）', ')') THEN n + 1 ELSE n END,
            CASE WHEN item = 0 THEN n + 1 ELSE item END, coalesce(stack[-1], 0), CAST(len(stack) AS INTEGER), CASE WHEN ts[i + 1] NOT IN ('（', '(', '、', '）', ')') THEN ts[i + 1] END
        FROM walk WHERE i < len(ts)),
    words AS (SELECT *, i = max(i) OVER (PARTITION BY code, parent) AND parent > 0 AS last_ FROM walk WHERE word IS NOT NULL),
    modes AS (SELECT code, parent AS node, CASE regexp_extract(word, '(に限る|を除く)。?$', 1) WHEN 'に限る' THEN 'only' WHEN 'を除く' THEN 'except' ELSE 'note' END AS mode FROM words WHERE last_),
    names AS (SELECT code, node, parent, depth, CASE WHEN last_ THEN regexp_replace(word, '(に限る|を除く)。?$', '') ELSE word END AS name FROM words QUALIFY row_number() OVER (PARTITION BY code, node ORDER BY i) = 1),
    placed AS (SELECT n.*, mode FROM names n LEFT JOIN modes m ON n.code = m.code AND n.node = m.node),
    tree AS (
        SELECT code, node, parent, depth, name, mode, true AS included FROM placed WHERE depth = 0
        UNION ALL SELECT p.code, p.node, p.parent, p.depth, p.name, p.mode, t.included <> coalesce(t.mode = 'except', false) FROM tree t JOIN placed p ON t.code = p.code AND t.node = p.parent)"""


@register(QUERIES, SQL, f"WITH RECURSIVE {_TREE} SELECT code AS area_code, node, parent, depth, name, mode, included FROM tree")
def telephone_clauses(spark, d):
    """The clauses of coverage texts as trees."""
    return matching.clause_tree(_areas(spark, d)).select("area_code", "node", "parent", "depth", "name", "mode", "included")


@register(QUERIES, SQL, f"""WITH RECURSIVE {_TREE}, wards AS (SELECT DISTINCT 'c' || c_custkey // 30 || '市' AS m, w FROM customer, (VALUES ('東区'), ('西区'), ('北区'), ('南区')) v(w)),
    clauses AS (SELECT code, node, mode, replace(name, 'A県', '') AS m FROM tree WHERE depth = 0 AND mode IS DISTINCT FROM 'note' AND right(name, 1) IN ('市', '町'))
    SELECT c.code AS area_code, c.m AS municipality_name, w.w AS ward,
           CASE WHEN t.node IS NULL AND c.mode = 'only' THEN 'none' WHEN t.node IS NULL THEN 'whole' WHEN t.mode IS NOT NULL THEN 'partial' WHEN t.included THEN 'whole' ELSE 'none' END AS coverage
    FROM clauses c JOIN wards w USING (m) LEFT JOIN tree t ON t.code = c.code AND t.parent = c.node AND t.name = w.w""")
def ward_coverage(spark, d):
    """Which wards the clauses of coverage texts reach."""
    k = F.concat(F.lit("c"), F.floor(F.col("c_custkey") / 30).cast("string"), F.lit("市"))
    wards = table(spark, d, "customer").select(k.alias("municipality_name"), F.explode(F.array(*map(F.lit, ("東区", "西区", "北区", "南区")))).alias("ward")).distinct()
    return matching.ward_coverage(_areas(spark, d), wards)


@register(QUERIES, SQL, f"""WITH RECURSIVE {_TREE},
    clauses AS (SELECT code, node, CASE WHEN mode IS NULL THEN 'whole' ELSE 'partial' END AS kind, replace(name, 'A県', '') AS m FROM tree WHERE depth = 0 AND mode IS DISTINCT FROM 'note' AND right(name, 1) IN ('市', '町')),
    towns AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'c' || p_partkey // 40 || '市' ELSE 'd' || p_partkey // 26 || '町' END AS m FROM part),
    decided AS (SELECT p_partkey AS id, 'X' AS target FROM part WHERE p_partkey % 17 = 0),
    per AS (SELECT m, kind, count(DISTINCT code) AS n FROM clauses GROUP BY m, kind),
    found AS (
        SELECT id, target, 'T0' AS rule, 1.0 AS conf, true AS whole FROM decided
        UNION ALL SELECT DISTINCT t.id, c.code::VARCHAR, CASE WHEN c.kind = 'partial' THEN 'T3' WHEN n = 1 THEN 'T1' ELSE 'T6' END, CASE WHEN c.kind = 'whole' AND n = 1 THEN 1.0 ELSE 0.5 END, c.kind = 'whole'
        FROM towns t JOIN clauses c USING (m) JOIN per ON per.m = c.m AND per.kind = c.kind
        WHERE t.id NOT IN (SELECT id FROM decided) AND (c.kind = 'whole' OR c.m NOT IN (SELECT m FROM per WHERE kind = 'whole'))),
    kept AS (SELECT t.id, f.target, coalesce(rule, 'unresolved') AS rule, coalesce(conf, 0.0) AS conf, coalesce(whole, true) AS whole FROM towns t LEFT JOIN found f ON t.id = f.id),
    n AS (SELECT *, count(target) OVER (PARTITION BY id) AS c FROM kept)
    SELECT id, target, rule AS matching_rule_id, conf::DOUBLE AS confidence, 'grp_' || substr(sha256(id::VARCHAR), 1, 16) AS candidate_group_id, c AS candidate_count, whole AS candidate_count_is_complete,
           c = 1 AS is_unique_match, CASE WHEN c = 0 THEN 'unresolved' WHEN c = 1 THEN 'exact' ELSE 'ambiguous' END AS relation_type, CASE WHEN c = 1 THEN 'auto' ELSE 'review_required' END AS verification_status FROM n""")
def telephone_rules(spark, d):
    """Municipalities, a few of them decided by a person, matched to numbering areas by their clauses."""
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("c"), F.floor(k / 40).cast("string"), F.lit("市"))).otherwise(F.concat(F.lit("d"), F.floor(k / 26).cast("string"), F.lit("町")))
    part = table(spark, d, "part")
    decided = part.filter(k % 17 == 0).select(k.alias("id"), F.lit("X").alias("target"))
    return matching.telephone(part.select(k.alias("id"), name.alias("name")), durable(matching.coverage_clauses(_areas(spark, d))), decided)
