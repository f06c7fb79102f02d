"""Versions, identity, overrides, diffs and gates on stand-in releases."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..durable import durable, remove_folder, shared_folder
from ..operators import gates, history, similarity, trees, versioning
from ..sources import release_files
from .inputs import register, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

_SCD = """
    prev AS (SELECT c_custkey AS k, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, CASE WHEN c_custkey % 9 = 0 THEN '2026-09-20' ELSE '2026-08-01' END AS observed_from,
                    CASE WHEN c_custkey % 13 = 0 THEN '2026-08-15' END AS observed_to, c_custkey % 13 <> 0 AS is_current, 'v1_' || c_custkey AS ver_id FROM customer WHERE c_custkey % 5 <> 0),
    cur AS (SELECT c_custkey AS k, c_name AS name, CAST(CASE WHEN c_custkey % 6 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS VARCHAR) AS nation, '2026-09-17' AS observed_from, NULL AS observed_to, true AS is_current, 'v2_' || c_custkey AS ver_id
            FROM customer WHERE c_custkey % 7 <> 0),
    live AS (SELECT * FROM prev WHERE is_current)
"""


def _releases(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    nation = F.when(k % 6 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).cast("string")
    prev = c.filter(k % 5 != 0).select(k.alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("nation"), F.when(k % 9 == 0, "2026-09-20").otherwise("2026-08-01").alias("observed_from"), F.when(k % 13 == 0, "2026-08-15").alias("observed_to"), (k % 13 != 0).alias("is_current"), F.concat(F.lit("v1_"), k.cast("string")).alias("ver_id"))
    cur = c.filter(k % 7 != 0).select(k.alias("k"), F.col("c_name").alias("name"), nation.alias("nation"), F.lit("2026-09-17").alias("observed_from"), F.lit(None).cast("string").alias("observed_to"), F.lit(True).alias("is_current"), F.concat(F.lit("v2_"), k.cast("string")).alias("ver_id"))
    return cur, prev


@register(QUERIES, SQL, f"""WITH {_SCD}
    SELECT * FROM prev WHERE NOT is_current
    UNION ALL SELECT p.* FROM live p JOIN cur c ON p.k = c.k WHERE p.name = c.name AND p.nation = c.nation
    UNION ALL SELECT p.k, p.name, p.nation, p.observed_from, greatest('2026-09-17', p.observed_from), false, p.ver_id FROM live p LEFT JOIN cur c ON p.k = c.k WHERE c.k IS NULL OR p.name <> c.name OR p.nation <> c.nation
    UNION ALL SELECT c.k, c.name, c.nation, CASE WHEN p.k IS NULL THEN c.observed_from ELSE greatest('2026-09-17', p.observed_from) END, NULL, true, c.ver_id FROM cur c LEFT JOIN live p ON p.k = c.k WHERE p.k IS NULL OR p.name <> c.name OR p.nation <> c.nation""")
def scd2_carry_forward(spark, d):
    cur, prev = _releases(spark, d)
    return versioning.carry_forward(cur, prev, "k", "ver_id", "2026-09-17")


@register(QUERIES, SQL, SQL["scd2_carry_forward"])
def scd2_history(spark, d):
    """The same through bucketed tables: the earlier release's open rows are joined where they lie, its closed rows are not read."""
    cur, prev = _releases(spark, d)
    folder = f"{shared_folder(spark)}/scd2-{uuid.uuid4().hex}"
    h = history.History(spark, f"scd2_{uuid.uuid4().hex}", "k", "ver_id", buckets=8, folder=folder)
    try:
        h.advance(prev.filter("is_current"), 0, "2026-08-01")
        h.advance(cur, 1, "2026-09-17")
        return durable(h.rows(1).unionByName(prev.filter("NOT is_current")))
    finally:
        for name in (f"{h.name}_open_0", f"{h.name}_open_1", f"{h.name}_closed"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_folder(spark, folder)


@register(QUERIES, SQL, "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def release_files_read(spark, d):
    """A table written as release files by the executors, checked against the manifest and read back."""
    folder = f"{shared_folder(spark)}/release-{uuid.uuid4().hex}"
    try:
        release_files.write_release(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), folder, ["c_custkey"], rows_per_file=1000)
        release_files.check_release(spark, folder)
        return durable(release_files.read_release(spark, folder))
    finally:
        remove_folder(spark, folder)


@register(QUERIES, SQL, f"""WITH {_SCD}, ch AS (SELECT p.k, unnest(['nation', 'name']) AS field, unnest([p.nation, p.name]) AS old_value, unnest([c.nation, c.name]) AS new_value FROM live p JOIN cur c ON p.k = c.k)
    SELECT 'his_' || substr(sha256(concat_ws(chr(31), '=' || k, '=' || field, '=' || old_value, '=' || new_value)), 1, 16) AS history_id, k, field, old_value, new_value FROM ch WHERE old_value <> new_value""")
def address_history(spark, d):
    cur, prev = _releases(spark, d)
    return versioning.field_history(cur, prev.filter("is_current"), "k", ["nation", "name"])


_ID = """
    ledger AS (SELECT 'id' || p_partkey AS entity_id, 'a' || p_partkey % 10 AS area, 'c' || p_partkey AS code, p_name AS name, p_partkey % 17 <> 0 AS active FROM part WHERE p_partkey % 11 <> 0),
    towns AS (SELECT CASE WHEN p_partkey % 10 = 3 THEN 'b3' WHEN p_partkey % 10 = 4 THEN 'b' || (4 + p_partkey % 20 // 10) ELSE 'a' || p_partkey % 10 END AS area, CASE WHEN p_partkey % 19 = 0 THEN 'n' || p_partkey ELSE 'c' || p_partkey END AS code,
                     CASE WHEN p_partkey % 23 = 0 THEN p_name || '*' ELSE p_name END AS name FROM part WHERE p_partkey % 29 <> 0),
    live AS (SELECT * FROM ledger WHERE active),
    vanished AS (SELECT * FROM live l WHERE NOT EXISTS (SELECT 1 FROM towns t WHERE t.area = l.area AND t.code = l.code)),
    fresh AS (SELECT * FROM towns t WHERE NOT EXISTS (SELECT 1 FROM live l WHERE t.area = l.area AND t.code = l.code)),
    recoded AS (SELECT entity_id, r.new_area AS area, code, name FROM vanished v JOIN (VALUES ('a3', 'b3'), ('a4', 'b4'), ('a4', 'b5')) r(old_area, new_area) ON v.area = r.old_area),
    claims AS (SELECT f.area, f.code, v.entity_id, 'I2' AS by_rule FROM fresh f JOIN vanished v ON f.area = v.area AND f.name = v.name
               UNION SELECT f.area, f.code, r.entity_id, 'I3' FROM fresh f JOIN recoded r ON f.area = r.area AND f.code = r.code AND f.name = r.name),
    claimed AS (SELECT entity_id, count(DISTINCT (area, code)) AS claimants FROM claims GROUP BY entity_id),
    of_town AS (SELECT area, code, count(DISTINCT entity_id) AS claims, max(claimants) AS claimants, min(entity_id) AS claim, min(by_rule) AS by_rule FROM claims JOIN claimed USING (entity_id) GROUP BY area, code),
    j AS (SELECT f.*, claim, by_rule, claims IS NOT NULL AS claiming, coalesce(claims = 1 AND claimants = 1, false) AS settled, (SELECT count(*) FROM ledger g WHERE NOT active AND g.area = f.area AND g.code = f.code) AS retired,
                 EXISTS (SELECT 1 FROM recoded r WHERE r.area = f.area AND r.code = f.code) AS renamed, EXISTS (SELECT 1 FROM vanished v WHERE v.code = f.code AND v.name = f.name) AS elsewhere FROM fresh f LEFT JOIN of_town o ON f.area = o.area AND f.code = o.code)
"""


def _ledger(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    area = F.concat(F.lit("a"), (k % 10).cast("string"))
    ledger = p.filter(k % 11 != 0).select(F.concat(F.lit("id"), k.cast("string")).alias("entity_id"), area.alias("area"), F.concat(F.lit("c"), k.cast("string")).alias("code"), F.col("p_name").alias("name"), (k % 17 != 0).alias("active"))
    towns = p.filter(k % 29 != 0).select(F.when(k % 10 == 3, "b3").when(k % 20 == 4, "b4").when(k % 20 == 14, "b5").otherwise(area).alias("area"), F.concat(F.when(k % 19 == 0, "n").otherwise("c"), k.cast("string")).alias("code"), F.when(k % 23 == 0, F.concat("p_name", F.lit("*"))).otherwise(F.col("p_name")).alias("name"))
    return towns, ledger


@register(QUERIES, SQL, f"""WITH {_ID}
    SELECT t.area, t.code, t.name, l.entity_id, CASE WHEN l.name = t.name THEN 'I1' ELSE 'I4' END AS rule, CAST(NULL AS VARCHAR) AS review FROM towns t JOIN live l ON t.area = l.area AND t.code = l.code
    UNION ALL SELECT area, code, name, CASE WHEN settled THEN claim ELSE 'tsr1' || substr(sha256(concat_ws(chr(31), area, code, CASE WHEN retired > 0 THEN 'again' || retired ELSE 'first' END)), 1, 16) END,
        CASE WHEN settled THEN by_rule WHEN retired > 0 THEN 'I6' ELSE 'I5' END,
        CASE WHEN settled THEN NULL WHEN claiming THEN by_rule || '_ambiguous' WHEN retired > 0 THEN 'I6_reinstatement_candidate' WHEN renamed THEN 'I3_renamed' WHEN elsewhere THEN 'I3_unattested' END FROM j""")
def identity_resolve(spark, d):
    """One area is recoded to another, one is split in two; both by attestation."""
    towns, ledger = _ledger(spark, d)
    out = versioning.resolve_identity(towns, ledger, spark.createDataFrame([("a3", "b3"), ("a4", "b4"), ("a4", "b5")], "old_area string, new_area string"))
    out = durable(out)  # checked as it stands, not worked out twice
    versioning.check_identity(out)
    return out


@register(QUERIES, SQL, f"""WITH {_ID}, rows_ AS (
        SELECT l.entity_id, CASE WHEN l.name <> t.name THEN 'renamed' END AS relation_type, l.area AS old_area, l.code AS old_code, l.name AS old_name, t.area, t.code, t.name FROM live l JOIN towns t ON t.area = l.area AND t.code = l.code
        UNION ALL SELECT v.entity_id, CASE j.by_rule WHEN 'I2' THEN 'code_corrected' WHEN 'I3' THEN 'municipality_recoded' ELSE 'retired' END, v.area, v.code, v.name, j.area, j.code, j.name FROM vanished v LEFT JOIN j ON j.settled AND j.claim = v.entity_id)
    SELECT * FROM rows_ WHERE relation_type IS NOT NULL""")
def identity_lineage(spark, d):
    towns, ledger = _ledger(spark, d)
    out = versioning.resolve_identity(towns, ledger, spark.createDataFrame([("a3", "b3"), ("a4", "b4"), ("a4", "b5")], "old_area string, new_area string"))
    return versioning.identity_lineage(ledger, out)


_ORD = """
    cur AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 12 = 0 THEN 'Z' ELSE o_orderstatus END AS relation_type, CASE WHEN o_orderkey % 14 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS confidence, CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE o_orderpriority END AS verification_status FROM orders WHERE o_orderkey % 5 <> 0),
    prev AS (SELECT o_orderkey AS k, o_orderstatus AS relation_type, o_totalprice AS confidence, CASE WHEN o_orderkey % 16 = 0 THEN 'other' ELSE o_orderpriority END AS verification_status FROM orders WHERE o_orderkey % 7 <> 0)
"""


def _orders(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    cur = o.filter(k % 5 != 0).select(k.alias("k"), F.when(k % 12 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("relation_type"), F.when(k % 14 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("confidence"), F.when(k % 15 != 0, F.col("o_orderpriority")).alias("verification_status"))
    prev = o.filter(k % 7 != 0).select(k.alias("k"), F.col("o_orderstatus").alias("relation_type"), F.col("o_totalprice").alias("confidence"), F.when(k % 16 == 0, "other").otherwise(F.col("o_orderpriority")).alias("verification_status"))
    return cur, prev


@register(QUERIES, SQL, f"""WITH {_ORD} SELECT count(*) FILTER (WHERE p.k IS NULL) AS added, count(*) FILTER (WHERE c.k IS NULL) AS removed,
    count(*) FILTER (WHERE p.relation_type <> c.relation_type) AS relation_type_changed, count(*) FILTER (WHERE p.confidence <> c.confidence) AS confidence_changed, count(*) FILTER (WHERE p.verification_status <> c.verification_status) AS verification_status_changed
    FROM cur c FULL JOIN prev p ON c.k = p.k""")
def diff_bridge(spark, d):
    return gates.bridge_diff(*_orders(spark, d), "k")


@register(QUERIES, SQL, f"""WITH {_ORD} SELECT count(*) FILTER (WHERE p.k IS NULL) AS added, count(*) FILTER (WHERE c.k IS NULL) AS removed, count(*) FILTER (WHERE c.k IS NULL AND p.k % 10 = 0) AS explained,
    count(*) FILTER (WHERE c.k IS NULL AND p.k % 10 <> 0) AS unexplained, count(*) FILTER (WHERE p.verification_status <> c.verification_status) AS renamed, count(*) FILTER (WHERE p.relation_type <> c.relation_type) AS recoded
    FROM cur c FULL JOIN prev p ON c.k = p.k""")
def diff_entities(spark, d):
    cur, prev = _orders(spark, d)
    return gates.entity_diff(cur, prev, prev.filter("k % 10 = 0").select("k"), "k", "verification_status", "relation_type")


@register(QUERIES, SQL, f"""WITH {_ORD}, a AS (SELECT 'added' AS kind, k FROM cur WHERE k NOT IN (SELECT k FROM prev) ORDER BY k LIMIT 25), r AS (SELECT 'removed' AS kind, k FROM prev WHERE k NOT IN (SELECT k FROM cur) ORDER BY k LIMIT 25)
    SELECT * FROM a UNION ALL SELECT * FROM r""")
def diff_keys(spark, d):
    """The report's samples: the first 25 keys added and removed."""
    cur, prev = _orders(spark, d)
    found = gates.diff_keys(cur, prev, "k")
    return spark.createDataFrame([(kind, k) for kind in ("added", "removed") for k in found[f"{kind}_sample"]], "kind string, k long")


@register(QUERIES, SQL, f"WITH {_ORD} SELECT k FROM prev WHERE k NOT IN (SELECT k FROM cur) AND k % 10 <> 0")
def unexplained_removals(spark, d):
    cur, prev = _orders(spark, d)
    return gates.unexplained_removals(cur, prev, prev.filter("k % 10 = 0").select("k"), "k")


@register(QUERIES, SQL, """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'manually_verified' WHEN o_orderstatus = 'P' THEN 'review_required' ELSE 'auto' END AS verification_status,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'manual_override' ELSE 'R1' END AS matching_rule_id, o_orderstatus = 'P' AS override_stale FROM orders""")
def overrides_apply(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.lit("auto").alias("verification_status"), F.lit("R1").alias("matching_rule_id"), F.lit(False).alias("override_stale"))
    decided = [
        {"id": "a", "where": {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}, "set": {"verification_status": "manually_verified"}, "source_state": {"s": "1"}},
        {"id": "b", "where": {"o_orderstatus": "P"}, "set": {"verification_status": "manually_verified"}, "source_state": {"s": "0"}},
        {"id": "c", "where": {"nowhere": "P"}, "set": {"verification_status": "manually_verified"}, "source_state": {"s": "1"}},
    ]
    out, _ = gates.apply_overrides(o, decided, {"s": "1"})
    return out.select("o_orderkey", "verification_status", "matching_rule_id", "override_stale")


@register(QUERIES, SQL, """
    WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'P' ELSE 'F' END AS status, c_mktsegment AS segment, c_custkey % 6 = 5 AS stale FROM customer),
    hit AS (  -- by customer and status; every tenth also by the customer alone, later in order
        SELECT o.*, d.c_custkey AS place, 'keyed' AS by_, d.segment, d.stale FROM orders o JOIN d ON o_custkey = d.c_custkey AND o_orderstatus = d.status
        UNION ALL SELECT o.*, 1000000000 + d.c_custkey, 'alone', d.segment, false FROM orders o JOIN d ON o_custkey = d.c_custkey AND d.c_custkey % 10 = 0),
    last_ AS (
        SELECT o_orderkey, arg_max(segment, place) FILTER (WHERE NOT stale) AS segment, max(place) FILTER (WHERE NOT stale) AS fresh, bool_or(stale) AS stale, max(place) FILTER (WHERE stale) AS marked FROM hit GROUP BY o_orderkey)
    SELECT o.o_orderkey, coalesce(l.segment, o.o_orderpriority) AS o_orderpriority, CASE WHEN fresh IS NULL THEN 'R1' ELSE 'manual_override' END AS matching_rule_id,
           CASE WHEN fresh IS NULL AND marked IS NULL THEN 'auto' WHEN fresh IS NULL OR marked > fresh THEN 'review_required' ELSE 'manually_verified' END AS verification_status, coalesce(l.stale, false) AS override_stale
    FROM orders o LEFT JOIN last_ l ON o.o_orderkey = l.o_orderkey""")
def decisions_apply(spark, d):
    """Decisions as data: one or two for each customer, some of them stale."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.lit("auto").alias("verification_status"), F.lit("R1").alias("matching_rule_id"), F.lit(False).alias("override_stale"))
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    what = F.create_map(F.lit("o_orderpriority"), F.col("c_mktsegment"), F.lit("verification_status"), F.lit("manually_verified")).alias("set")
    status = F.when(k % 4 == 3, "P").otherwise("F")
    keyed = c.select(k.alias("order"), k.cast("string").alias("id"), (k % 6 == 5).alias("stale"), F.create_map(F.lit("o_custkey"), k.cast("string"), F.lit("o_orderstatus"), status).alias("where"), what)
    alone = c.filter(k % 10 == 0).select((k + 1_000_000_000).alias("order"), k.cast("string").alias("id"), F.lit(False).alias("stale"), F.create_map(F.lit("o_custkey"), k.cast("string")).alias("where"), what)
    out, _ = gates.apply_decisions(o, keyed.unionByName(alone))
    return out.drop("o_custkey", "o_orderstatus")


@register(QUERIES, SQL, """
    WITH a AS (SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'other' ELSE n_name END AS expected, CASE WHEN n_nationkey % 4 = 0 THEN 'ASIA' END AS forbidden, 's' || n_nationkey % 5 AS source FROM nation)
    SELECT id, expected = 'other' AS code_name_differs, forbidden IS NOT NULL AS forbidden_exists, source = 's4' AS source_corrected, expected <> 'other' AND forbidden IS NULL AND source <> 's4' AS applies FROM a""")
def alias_preconditions(spark, d):
    n = table(spark, d, "nation")
    a = n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_nationkey").alias("code"), F.when(F.col("n_nationkey") % 3 == 0, "other").otherwise(F.col("n_name")).alias("expected_name"), F.when(F.col("n_nationkey") % 4 == 0, "ASIA").alias("forbidden_name"), F.concat(F.lit("s"), (F.col("n_nationkey") % 5).cast("string")).alias("source"), F.lit("x").alias("area"), F.col("n_name").alias("published"))
    names = n.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")).unionByName(table(spark, d, "region").select((F.col("r_regionkey") + 1000).alias("code"), F.lit("ASIA").alias("name")))
    return gates.judge_aliases(a, names, a.filter("source <> 's4'").select("source", "area", "published"))


@register(QUERIES, SQL, """SELECT 'o_' || o_orderstatus AS metric, count(*) AS value, CASE WHEN o_orderstatus = 'P' THEN 'approved' WHEN count(*) > 2000 THEN 'fail' WHEN count(*) > 10 THEN 'warn' ELSE 'pass' END AS verdict FROM orders GROUP BY o_orderstatus""")
def rate_gates(spark, d):
    m = table(spark, d, "orders").groupBy(F.concat(F.lit("o_"), F.col("o_orderstatus")).alias("metric")).agg(F.count("*").alias("value"))
    limits = m.select("metric", F.lit(10).alias("warn"), F.lit(2000).alias("fail"))
    return gates.gate(m, limits, m.filter("metric = 'o_P'").select("metric", "value"))


@register(QUERIES, SQL, "SELECT o_orderkey, o_orderstatus, CAST(-1 AS BIGINT) AS surplus FROM orders WHERE o_orderkey % 100 = 0")
def table_multiset_difference(spark, d):
    """Two builds compared without their clock columns: the second has some rows once more."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit("now").alias("created_at"))
    again = o.withColumn("created_at", F.lit("later"))
    return gates.multiset_differences(o, again.unionByName(again.filter("o_orderkey % 100 = 0")))


@register(QUERIES, SQL, f"""WITH {_ORD}, a AS (SELECT * FROM cur EXCEPT ALL SELECT * FROM prev), b AS (SELECT * FROM prev EXCEPT ALL SELECT * FROM cur)
    SELECT *, count(*) AS surplus FROM a GROUP BY ALL UNION ALL SELECT *, -count(*) FROM b GROUP BY ALL""")
def release_tree_diff(spark, d):
    """Two releases written as hash trees, compared range by range."""
    folder = f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}"
    cur, prev = _orders(spark, d)
    trees.write_tree(cur, f"{folder}/now", ["k"], depth=1)
    trees.write_tree(prev, f"{folder}/before", ["k"], depth=1)
    out = durable(trees.tree_diff(spark, f"{folder}/now", f"{folder}/before"))
    remove_folder(spark, folder)
    return out


#: Who refers to whom; a few parents lack rows.
_REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey"), ("labels", "doc_id", "documents", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"), ("pages", "page_id", "documents", "doc_id"),
]
_LACKING = {"orders": "o_orderkey % 97 <> 5", "part": "p_partkey % 50 <> 7", "customer": "c_custkey % 31 <> 3", "nation": "n_nationkey <> 11"}


@register(QUERIES, SQL, " UNION ALL ".join(
    f"""SELECT '{c}.{a} -> {p}.{k}' AS reference, count(*) AS child_rows, count(*) FILTER (WHERE lost) AS lost_rows, count(DISTINCT key) FILTER (WHERE lost) AS lost_keys, min(key) FILTER (WHERE lost) AS least_lost
    FROM (SELECT CAST({a} AS VARCHAR) AS key, {a} NOT IN (SELECT {k} FROM {p} WHERE {_LACKING.get(p, 'true')}) AS lost FROM {c} WHERE {_LACKING.get(c, 'true')})"""
    for c, a, p, k in _REFERENCES))
def reference_check(spark, d):
    """Ten references over ten tables, some of which lack rows, checked in one pass."""
    names = sorted({t for r in _REFERENCES for t in (r[0], r[2])})
    return trees.check_references({t: table(spark, d, t).filter(_LACKING.get(t, "true")) for t in names}, _REFERENCES)


@register(QUERIES, SQL, """
    WITH l AS (SELECT DISTINCT p_size AS block, p_brand || p_partkey % 40 AS name FROM part), r AS (SELECT DISTINCT p_size AS block, CASE WHEN p_partkey % 3 = 0 THEN reverse(p_brand) ELSE p_brand END || p_partkey % 60 AS name FROM part WHERE p_partkey % 2 = 1)
    SELECT l.block, l.name, r.name AS other, levenshtein(l.name, r.name) AS distance FROM l JOIN r ON l.block = r.block WHERE distance <= 2""")
def town_name_similarity(spark, d):
    """Names of one municipality (a size of part) that differ in two edits at most."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    left = p.select(F.col("p_size").alias("block"), F.concat("p_brand", (k % 40).cast("string")).alias("name"))
    right = p.filter(k % 2 == 1).select(F.col("p_size").alias("block"), F.concat(F.when(k % 3 == 0, F.reverse("p_brand")).otherwise(F.col("p_brand")), (k % 60).cast("string")).alias("name"))
    return similarity.similar_names(left, right, most=2)
