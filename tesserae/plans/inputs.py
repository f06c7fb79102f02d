"""Stand-in inputs from the test tables. Readers of real payloads are in ``sources``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TABLES = "region nation customer supplier part orders lineitem events documents".split()


def over_tables(spark: SparkSession, sf_dir: str, text: str, **args) -> DataFrame:
    """SQL over the test tables, which are handed to it as they are: the session's views stay as they were."""
    text = re.sub(rf"(?:(?<=FROM )|(?<=JOIN )|(?<=[a-z], ))({'|'.join(_TABLES)})\b(?![.'])", r"{\1}", text)
    return spark.sql(text, args=args, **{t: table(spark, sf_dir, t) for t in _TABLES if f"{{{t}}}" in text})


def register(registry: dict, sql: dict[str, str], oracle: str | None = None):
    """Decorator: a query under its function's name, with its SQL."""

    def put(f):
        registry[f.__name__] = f
        if oracle:
            sql[f.__name__] = oracle
        return f

    return put


def stops(spark, d) -> DataFrame:
    """Points: a line item at (extended price, quantity)."""
    rows = table(spark, d, "lineitem")
    return rows.select(F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"), F.col("l_returnflag").alias("name"), F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"))


def squares(spark, d) -> DataFrame:
    """Polygons: a box for each nation, 5000 wide every 2000, up to y = 40."""
    p = lambda x, y: F.struct(x.alias("x"), F.lit(float(y)).alias("y"))
    x0 = F.col("n_nationkey") * F.lit(2000.0)
    x1 = x0 + F.lit(5000.0)
    ring = F.array(p(x0, 0), p(x1, 0), p(x1, 40), p(x0, 40))
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("shape_id"), F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("code"), F.array(ring).alias("rings"))


def current_codes(spark, d) -> DataFrame:
    """Codes not divisible by five are current."""
    n = table(spark, d, "nation").filter("n_nationkey % 5 <> 0")
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("code"), F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("lg_code"))


def successor_codes(spark, d) -> DataFrame:
    """Of the others, 5 and 15 have one successor, 10 and 20 two, 0 none."""
    n = table(spark, d, "nation").filter("n_nationkey % 5 = 0 AND n_nationkey > 0")
    both = n.select(F.col("n_nationkey").alias("k"), F.explode(F.when(F.col("n_nationkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("step"))
    return both.select(F.lpad(F.col("k").cast("string"), 5, "0").alias("code"), F.concat(F.lit("L"), (F.col("k") + F.col("step")).cast("string")).alias("lg_code"))


CELL = (2500.0, 20.0)

#: The same inputs in SQL, for oracles.
SQL = """
    stops AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id, l_returnflag AS name, l_extendedprice AS x, l_quantity AS y FROM lineitem),
    boxes AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, n_nationkey * CAST(2000 AS DOUBLE) AS x0, n_nationkey * CAST(2000 AS DOUBLE) + 5000 AS x1 FROM nation),
    corners AS (
        SELECT code, unnest([x0, x1, x1, x0]) AS ax, unnest([0.0, 0.0, 40.0, 40.0])::DOUBLE AS ay,
               unnest([x1, x1, x0, x0]) AS bx, unnest([0.0, 40.0, 40.0, 0.0])::DOUBLE AS by, x0, x1 FROM boxes
    ),
    hits AS (
        SELECT s.id, c.code FROM stops s JOIN corners c ON s.x BETWEEN c.x0 AND c.x1 AND (c.ay > s.y) <> (c.by > s.y)
        WHERE s.x < c.ax + (s.y - c.ay) * (c.bx - c.ax) / nullif(c.by - c.ay, 0)
        GROUP BY s.id, c.code HAVING count(*) % 2 = 1
    ),
    now AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, 'L' || n_nationkey AS lg_code FROM nation WHERE n_nationkey % 5 <> 0),
    later AS (
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, 'L' || (n_nationkey + step) AS lg_code
        FROM nation, (VALUES (1), (2)) v(step) WHERE n_nationkey % 5 = 0 AND n_nationkey > 0 AND (step = 1 OR n_nationkey % 10 = 0)
    ),
    meant AS (
        SELECT b.code, coalesce(now.lg_code, later.lg_code) AS lg_code, now.lg_code IS NULL AND later.lg_code IS NOT NULL AS via
        FROM boxes b LEFT JOIN now ON b.code = now.code LEFT JOIN later ON b.code = later.code
    ),
    rows_ AS (
        SELECT s.id, s.name, m.code, m.lg_code, coalesce(m.via, false) AS via,
               CASE WHEN m.code IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY s.id) END AS n
        FROM stops s LEFT JOIN (SELECT hits.id, meant.* FROM hits JOIN meant ON hits.code = meant.code) m ON s.id = m.id
    ),
    bridge AS (
        SELECT id, name, lg_code, code AS boundary_code, n AS candidate_count,
               CASE WHEN code IS NULL THEN 'unresolved' WHEN n = 1 THEN 'contains' ELSE 'ambiguous' END AS relation_type,
               CASE WHEN code IS NULL THEN 'unresolved' WHEN via THEN 'spatial_containment_via_lineage' ELSE 'spatial_containment' END AS match_method,
               CASE WHEN code IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS confidence,
               CAST(CASE WHEN n = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_unique_match,
               CASE WHEN n = 1 AND lg_code IS NOT NULL THEN 'auto' ELSE 'review_required' END AS verification_status,
               CASE WHEN code IS NULL THEN 'in no polygon; not assigned to the nearest one'
                    WHEN via AND lg_code IS NOT NULL AND n <> 1 THEN 'code ' || code || ' was split; ' || lg_code || ' is one of its successors'
                    WHEN lg_code IS NULL THEN 'code ' || code || ' has no current counterpart'
                    WHEN n <> 1 THEN 'in several polygons; all candidates are kept' END AS mismatch_note
        FROM rows_
    )
"""
