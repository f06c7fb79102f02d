"""The query surface: the shapes of the documented query set, on the test tables.

Each has the operators of one or more documented queries: filters with parameters, joins of up to five tables, conditional and distinct aggregates, concatenation,
HAVING on an alias, top-k with a total order, correlated subqueries, UNION and UNION ALL, recursion (``bridges.lineage_walk``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .inputs import over_tables, register, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _sql(name: str, text: str, duck: str | None = None, **args):
    """A query in SQL: run by Spark with named parameters; DuckDB gets the same text with the values in place, or its own dialect."""

    def run(spark, d):
        return over_tables(spark, d, text, **args)

    run.__name__ = name
    given = duck or text
    for k, v in args.items():
        given = given.replace(f":{k}", f"'{v}'" if isinstance(v, str) else str(v))
    register(QUERIES, SQL, given)(run)


_sql("filter_by_parameter", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = :status AND o_totalprice BETWEEN :low AND :high", status="F", low=1000, high=200000)
_sql("distinct_pairs", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority <> :skip", skip="5-LOW")
_sql("join_two", "SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment = :segment", segment="BUILDING")
_sql("join_three_distinct", "SELECT DISTINCT n.n_name, c.c_mktsegment, o.o_orderstatus FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey")
_sql("join_five", "SELECT DISTINCT r.r_name, s.s_name, p.p_brand FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey WHERE p.p_size < :size", size=10)
_sql("join_using", "SELECT k, c_name, n_orders FROM (SELECT c_custkey AS k, c_name FROM customer) a JOIN (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY o_custkey) b USING (k)")
_sql("ambiguous_topk", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = :flag ORDER BY l_quantity DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 100", flag="R")
_sql("having_alias_topk", "SELECT l_partkey, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY l_partkey HAVING n_suppliers > 1 ORDER BY n_suppliers DESC, l_partkey LIMIT 50")
_sql("split_entities", "SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n_segments, array_join(array_sort(collect_set(c_mktsegment)), ',') AS segments FROM customer GROUP BY c_nationkey HAVING n_segments > 1",
     "SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n_segments, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY c_nationkey HAVING n_segments > 1")
_sql("group_concat_rows", "SELECT o_custkey, listagg(o_orderstatus, ';') WITHIN GROUP (ORDER BY o_orderstatus) AS statuses, max(o_orderkey) AS last_order FROM orders GROUP BY o_custkey",
     "SELECT o_custkey, string_agg(o_orderstatus, ';' ORDER BY o_orderstatus) AS statuses, max(o_orderkey) AS last_order FROM orders GROUP BY o_custkey")
_sql("partial_text", "SELECT p_partkey, p_name FROM part WHERE p_type LIKE :like ESCAPE '!' AND p_name IS NOT NULL", like="%E%")
_sql("unmatched_by_kind", "SELECT o_orderstatus AS kind, count(*) AS n FROM orders WHERE o_custkey % 3 = 0 GROUP BY o_orderstatus")
_sql("provenance", "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, substr(s.s_name, 1, 8) AS supplier, substr(p.p_name, 1, 12) AS part FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_orderkey = :k", k=7)
_sql("profile_subqueries", """SELECT n.n_nationkey, n.n_name, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS n_customers, (SELECT count(DISTINCT c_mktsegment) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS n_segments,
    (SELECT count(*) FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS n_suppliers, (SELECT count(DISTINCT o.o_orderstatus) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_nationkey = n.n_nationkey) AS n_statuses, r.r_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
_sql("union_dedupe", """WITH wards AS (SELECT n_nationkey AS k FROM nation WHERE n_regionkey = :region UNION SELECT b.n_nationkey AS k FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey WHERE a.n_nationkey = :nation)
    SELECT s.s_suppkey, s.s_name FROM supplier s JOIN wards w ON s.s_nationkey = w.k""", region=1, nation=3)
_sql("self_join_parent", "SELECT p.n_name AS parent, c.n_name AS child FROM nation p LEFT JOIN nation c ON c.n_regionkey = p.n_regionkey AND c.n_nationkey > p.n_nationkey")
_sql("left_join_residual", "SELECT s.s_suppkey, n.n_name, (n.n_nationkey IS NOT NULL) AS found FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey AND n.n_regionkey = 2")
_sql("conditional_distinct", """SELECT c.c_nationkey, c.c_mktsegment, count(DISTINCT o.o_custkey) AS buyers, count(DISTINCT CASE WHEN o.o_orderstatus = 'F' THEN o.o_custkey END) AS buyers_f,
    round(1000.0D * count(DISTINCT o.o_custkey) / nullif(sum(c.c_acctbal), 0), 1) AS per_thousand FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey, c.c_mktsegment""",
     """SELECT c.c_nationkey, c.c_mktsegment, count(DISTINCT o.o_custkey) AS buyers, count(DISTINCT CASE WHEN o.o_orderstatus = 'F' THEN o.o_custkey END) AS buyers_f,
    round(CAST(1000 AS DOUBLE) * count(DISTINCT o.o_custkey) / nullif(sum(c.c_acctbal), 0), 1) AS per_thousand FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey, c.c_mktsegment""")
_sql("conditional_share", """SELECT p_brand, cast(sum(CASE WHEN p_size BETWEEN 1 AND 14 THEN 1 ELSE 0 END) AS bigint) AS young, cast(sum(CASE WHEN p_size >= 40 THEN 1 ELSE 0 END) AS bigint) AS old,
    round(100.0D * sum(CASE WHEN p_size >= 40 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN p_size <> 20 THEN 1 ELSE 0 END), 0), 1) AS pct_old FROM part GROUP BY p_brand""",
     """SELECT p_brand, cast(sum(CASE WHEN p_size BETWEEN 1 AND 14 THEN 1 ELSE 0 END) AS bigint) AS young, cast(sum(CASE WHEN p_size >= 40 THEN 1 ELSE 0 END) AS bigint) AS old,
    round(CAST(100 AS DOUBLE) * sum(CASE WHEN p_size >= 40 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN p_size <> 20 THEN 1 ELSE 0 END), 0), 1) AS pct_old FROM part GROUP BY p_brand""")
_sql("union_all_tagged", "SELECT 'supplier' AS kind, s_suppkey AS k, s_name AS name FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT 'customer', c_custkey, NULL FROM customer WHERE c_acctbal < 0")
_sql("dataset_edition_rollup", "SELECT trim(TRAILING '0123456789' FROM concat(lang, '_', source)) AS dataset, min(n_chars) AS least, max(n_chars) AS most, count(*) AS n FROM documents WHERE source LIKE :like GROUP BY trim(TRAILING '0123456789' FROM concat(lang, '_', source))",
     "SELECT rtrim(concat(lang, '_', source), '0123456789') AS dataset, min(n_chars) AS least, max(n_chars) AS most, count(*) AS n FROM documents WHERE source LIKE :like GROUP BY 1", like="src%")


@register(QUERIES, SQL, """SELECT c_nationkey, CASE WHEN bool_and(c_acctbal > -900) THEN CAST(count(*) AS BIGINT) END AS population, CASE WHEN bool_and(c_acctbal > -900) THEN 'complete' ELSE 'member_not_whole' END AS value_status FROM customer GROUP BY c_nationkey""")
def population_rollup_strict(spark, d):
    """A sum only where every member is whole; else NULL and the reason."""
    whole = F.bool_and(F.col("c_acctbal") > -900)
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.when(whole, F.count("*")).alias("population"), F.when(whole, "complete").otherwise("member_not_whole").alias("value_status"))


@register(QUERIES, SQL, """SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS level, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")
def bridge_quality_metrics(spark, d):
    """Distributions of several columns in one pass."""
    return over_tables(spark, d, "SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS level, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")


@register(QUERIES, SQL, """SELECT count(*) AS n_rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates, count(*) - count(nullif(l_returnflag, 'N')) AS n_null, count(DISTINCT l_orderkey) AS n_keys,
    count(DISTINCT nullif(l_returnflag, 'N')) + CAST(max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_unique_with_null FROM lineitem""")
def source_metrics(spark, d):
    """Rows, duplicate keys, nulls and distinct values (NULL as a value) of a source, in one pass."""
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return table(spark, d, "lineitem").agg(F.count("*").alias("n_rows"), (F.count("*") - F.countDistinct(F.struct("l_orderkey", "l_linenumber"))).alias("n_duplicates"), F.count_if(flag.isNull()).alias("n_null"), F.countDistinct("l_orderkey").alias("n_keys"), (F.countDistinct(flag) + F.max(flag.isNull().cast("long"))).alias("n_unique_with_null"))


@register(QUERIES, SQL, """SELECT l_suppkey AS line, count(*) AS feature_count, min(l_partkey) AS first_station, count(DISTINCT l_shipdate) AS date_variants, count(DISTINCT l_returnflag) AS flag_variants FROM lineitem GROUP BY l_suppkey""")
def variant_rollup(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("line")).agg(F.count("*").alias("feature_count"), F.min("l_partkey").alias("first_station"), F.countDistinct("l_shipdate").alias("date_variants"), F.countDistinct("l_returnflag").alias("flag_variants"))


@register(QUERIES, SQL, """SELECT p_partkey, unnest(['size', 'brand']) AS age_class, unnest([CAST(p_size AS VARCHAR), p_brand]) AS value FROM part""")
def census_unpivot(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"), F.col("p_brand").alias("brand"))
    return p.unpivot("p_partkey", ["size", "brand"], "age_class", "value")
