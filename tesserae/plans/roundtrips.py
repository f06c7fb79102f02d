"""Readers, chunks, change tables and measures on the stand-in inputs: tables are written as payloads of the real formats, and what the readers make of them is held
against the tables. Payloads are made on the executors, a thousand keys each; keys do not repeat.
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo_pack
from ..operators import gates, points
from ..sources import decisions, readers
from .bridges import _bridge
from .inputs import SQL as INPUTS
from .inputs import register, squares, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def zip_payload(members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def csv_payload(columns: list[str] | None, rows, encoding: str) -> bytes:
    out = io.StringIO()
    writer = csv.writer(out)
    if columns:
        writer.writerow(columns)
    writer.writerows(rows)
    return out.getvalue().encode(encoding)


def dbf_payload(columns: list[str], rows, encoding: str) -> bytes:
    cells = [[v.encode(encoding) for v in r] for r in rows]
    widths = [max([1, *(len(r[i]) for r in cells)]) for i in range(len(columns))]
    head = struct.pack("<B3xIHH20x", 3, len(cells), 33 + 32 * len(columns), 1 + sum(widths))
    fields = b"".join(struct.pack("<11sc4xB15x", c.encode(encoding), b"C", w) for c, w in zip(columns, widths, strict=True))
    return head + fields + b"\r" + b"".join(b" " + b"".join(v.ljust(w) for v, w in zip(r, widths, strict=True)) for r in cells)


def shp_payload(shapes) -> bytes:
    """Polygons, each as a list of rings."""
    out = struct.pack(">i", 9994) + bytes(96)
    for i, rings in enumerate(shapes, 1):
        flat = [v for ring in rings for p in ring for v in p]
        starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
        body = struct.pack("<i4d2i", 5, min(flat[::2]), min(flat[1::2]), max(flat[::2]), max(flat[1::2]), len(rings), len(flat) // 2)
        body += struct.pack(f"<{len(rings)}i{len(flat)}d", *starts, *flat)
        out += struct.pack(">ii", i, len(body) // 2) + body
    return out


def _payloads(df: DataFrame, key: str, make) -> DataFrame:
    """(path, content): ``make(rows)`` of a thousand keys at a time, in the order of the key."""
    columns = [c for c in df.columns if c != key]

    def put(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(key)
        return pd.DataFrame({"path": [f"part-{int(frame['the file'].iloc[0])}"], "content": [make(frame[columns].values.tolist())]})

    return df.withColumn("the file", F.floor(F.col(key) / 1000)).groupBy("the file").applyInPandas(put, "path string, content binary")


def _texts(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return df.select(F.col(key).alias("the key"), *[F.col(c).cast("string").alias(c) for c in columns])


_PART = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size"


@register(QUERIES, SQL, f"{_PART}, 'part-' || (p_partkey // 1000) AS source_file, 'a/parts.csv' AS member, row_number() OVER (PARTITION BY p_partkey // 1000 ORDER BY part.p_partkey) - 1 AS row_ordinal FROM part")
def read_zip_csv(spark, d):
    """Headered CSV in zip files."""
    columns = ["p_partkey", "p_name", "p_brand", "p_size"]
    files = _payloads(_texts(table(spark, d, "part"), "p_partkey", columns), "the key", lambda rows: zip_payload({"a/parts.csv": csv_payload(columns, rows, "utf-8-sig"), "readme.txt": b"-"}))
    return readers.zip_csv(spark, files, columns)


@register(QUERIES, SQL, "SELECT CAST(s_suppkey AS VARCHAR) AS code, '〒' || s_name || ', \"東\"' AS name FROM supplier")
def read_cp932_csv(spark, d):
    """CSV without a header, in an encoding that the JVM's reader refuses, with quotes and commas in cells."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("the key"), F.col("s_suppkey").cast("string").alias("code"), F.concat(F.lit("〒"), "s_name", F.lit(', "東"')).alias("name"))
    files = _payloads(s, "the key", lambda rows: csv_payload(None, rows, "cp932"))
    return readers.plain_csv(spark, files, ["code", "name"], "cp932", header=False).select("code", "name")


@register(QUERIES, SQL, "SELECT p_brand AS BRAND, CAST(p_partkey AS VARCHAR) AS KEY, CASE WHEN p_size % 7 <> 0 THEN p_name || '町' END AS NAME, 'inner.zip/t.dbf' AS member FROM part")
def read_dbf(spark, d):
    """dBASE tables in archives in archives; some columns of several; blank cells are NULL."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("the key"), F.col("p_partkey").cast("string").alias("KEY"), F.when(F.col("p_size") % 7 != 0, F.concat("p_name", F.lit("町"))).otherwise("").alias("NAME"), F.col("p_brand").alias("BRAND"), F.lit("x").alias("MORE"))
    files = _payloads(p, "the key", lambda rows: zip_payload({"inner.zip": zip_payload({"t.dbf": dbf_payload(["KEY", "NAME", "BRAND", "MORE"], rows, "cp932")})}))
    return readers.dbf(spark, files, ["BRAND", "KEY", "NAME"]).select("BRAND", "KEY", "NAME", "member")


@register(QUERIES, SQL, """SELECT CAST(n_nationkey AS BIGINT) AS row_ordinal, n_nationkey * CAST(2000 AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, n_nationkey * CAST(2000 AS DOUBLE) + 5000 AS x1, CAST(40 AS DOUBLE) AS y1, CAST(1 AS BIGINT) AS n_parts, CAST(4 AS BIGINT) AS n_points,
    n_nationkey * CAST(8000 AS DOUBLE) + 10000 AS sum_x FROM nation""")
def read_shapes(spark, d):
    """Polygons of shapefiles in zip files."""
    boxes = squares(spark, d).select("shape_id", F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))).alias("rings"))
    files = _payloads(boxes, "shape_id", lambda rows: zip_payload({"s.shp": shp_payload([[[tuple(p) for p in ring] for ring in r[0]] for r in rows])}))
    total = F.aggregate(F.flatten("parts"), F.lit(0.0), lambda acc, p: acc + p["x"])
    return readers.shapes(spark, files, expect=5).select("row_ordinal", "x0", "y0", "x1", "y1", F.size("parts").cast("long").alias("n_parts"), F.size(F.flatten("parts")).cast("long").alias("n_points"), total.alias("sum_x"))


@register(QUERIES, SQL, """WITH f AS (SELECT s_suppkey // 1000 AS f, string_agg(s_suppkey || ',' || s_name || chr(13) || chr(10), '' ORDER BY s_suppkey) AS t, count(*) AS n FROM supplier GROUP BY 1)
    SELECT 'snp_' || substr(sha256(t), 1, 16) AS source_snapshot_id, 'suppliers' AS source, 'part-' || f AS path, sha256(t) AS sha256, CAST(strlen(t) AS BIGINT) AS size, n AS row_count FROM f""")
def snapshot_rows(spark, d):
    files = _payloads(_texts(table(spark, d, "supplier"), "s_suppkey", ["s_suppkey", "s_name"]), "the key", lambda rows: csv_payload(None, rows, "utf-8"))
    return readers.snapshots(spark, files, "suppliers", readers.plain_csv(spark, files, ["code", "name"], header=False))


@register(QUERIES, SQL, f"""WITH {INPUTS}, rings AS (SELECT code, x0, ax AS x, ay AS y FROM corners)
    SELECT 'c' || (CAST(code AS BIGINT) // 10) AS chunk, CAST(code AS BIGINT) AS code, CAST(code AS BIGINT) % 3 AS unit, count(*) AS n_points, round(sum(x), 3) AS sum_x, round(sum(y), 3) AS sum_y FROM rings GROUP BY code""")
def geo_chunks(spark, d):
    """Polygons packed into chunks and unpacked."""
    k = F.col("shape_id").cast("long")
    pieces = squares(spark, d).select(F.concat(F.lit("c"), F.floor(k / 10).cast("string")).alias("chunk"), F.lit(0.0).alias("ox"), F.lit(0.0).alias("oy"), k.alias("code"), (k % 3).alias("unit"), "rings")
    rings = geo_pack.unpack_chunks(geo_pack.pack_chunks(pieces).select("chunk", F.lit(0.0).alias("ox"), F.lit(0.0).alias("oy"), "data"))
    p = rings.select("chunk", "code", "unit", F.explode("points").alias("p"))
    return p.groupBy("chunk", "code", "unit").agg(F.count("*").alias("n_points"), F.round(F.sum("p.x"), 3).alias("sum_x"), F.round(F.sum("p.y"), 3).alias("sum_y"))


@register(QUERIES, SQL, """SELECT c_mktsegment AS chunk, 'chunks.put("lines","' || c_mktsegment || '","' || to_base64(encode(string_agg(c_name, ',' ORDER BY c_custkey))) || '");' || chr(10) AS script FROM customer GROUP BY c_mktsegment""")
def chunk_scripts(spark, d):
    """Chunks as scripts; here a chunk is a segment's names."""
    rows = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda r: r["c_name"]), ",").cast("binary").alias("data"))
    return geo_pack.chunk_scripts(rows, "lines")


_CHANGES = "SELECT 'C' || (p_partkey % 997) AS code, CASE WHEN p_partkey % 41 <> 0 THEN '20' || lpad(CAST(p_size AS VARCHAR), 2, '0') END AS date, p_brand || (p_partkey // 9) AS reason, p_partkey % 3 AS kind, p_partkey AS k FROM part"


def _changes(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    date = F.when(k % 41 != 0, F.concat(F.lit("20"), F.lpad(F.col("p_size").cast("string"), 2, "0")))
    rows = p.select(F.concat(F.lit("C"), (k % 997).cast("string")).alias("code"), date.alias("date"), F.concat("p_brand", F.floor(k / 9).cast("string")).alias("reason"), (k % 3).alias("kind"), k.alias("k"))
    return points.municipality_changes(rows, rows.filter("kind = 0"), rows.filter("kind = 1"), "code", "date", "reason")


@register(QUERIES, SQL, f"SELECT code, date, reason, k, CAST(kind AS INTEGER) AS kind, kind = 0 AS is_created, kind = 1 AS is_abolished, CASE WHEN date IS NULL THEN 'incomplete' ELSE 'parsed' END AS parse_status FROM ({_CHANGES})")
def change_tables(spark, d):
    """Changes marked by the two narrowed tables."""
    return _changes(spark, d).withColumn("kind", F.col("kind").cast("int"))


@register(QUERIES, SQL, f"""WITH c AS ({_CHANGES}), m AS (SELECT date, reason, code, bool_or(kind = 0) AS created, bool_or(kind = 1) AS abolished FROM c WHERE date IS NOT NULL GROUP BY ALL),
    pairs AS (SELECT a.code AS old, b.code AS new, a.date, a.reason AS event_type, a.code IS DISTINCT FROM b.code AS differs FROM m a LEFT JOIN m b ON a.date = b.date AND a.reason = b.reason AND
        (b.created OR (NOT b.abolished AND NOT EXISTS (SELECT 1 FROM m x WHERE x.date = a.date AND x.reason = a.reason AND x.created))) WHERE a.abolished),
    e AS (SELECT DISTINCT old, new, date, event_type FROM pairs WHERE new IS NULL OR differs)
    SELECT 'edg_' || substr(sha256(concat_ws(chr(31), old, new, date, event_type)), 1, 16) AS edge_id, old, new, date, event_type,
           new IS NOT NULL AND count(new) OVER (PARTITION BY old, date) = 1 AS is_unique, CASE WHEN new IS NULL THEN 'incomplete' ELSE 'parsed' END AS parse_status FROM e""")
def change_edges(spark, d):
    """Edges from the marked changes."""
    return points.lineage_edges(points.change_edges(_changes(spark, d), "code", "date", "reason"))


@register(QUERIES, SQL, """SELECT c_mktsegment AS school_code, c_custkey::VARCHAR AS successor_school_code, c_custkey % 3 <> 0 AS successor_listed FROM customer
    UNION ALL SELECT c_custkey::VARCHAR, (c_custkey * 2)::VARCHAR, c_custkey * 2 <= (SELECT max(c_custkey) FROM customer) AND c_custkey * 2 % 3 <> 0 FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0""")
def school_succession(spark, d):
    """Lists of successors as edges: a school that is listed, one that is not."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    schools = c.filter(k % 3 != 0).select(k.cast("string").alias("school_code"), F.when(k % 2 == 0, F.concat(F.lit(" "), (k * 2).cast("string"), F.lit(" ; "))).alias("successor_school_codes_raw"))
    groups = c.groupBy(F.col("c_mktsegment").alias("school_code")).agg(F.array_join(F.collect_list(k.cast("string")), ";").alias("successor_school_codes_raw"))
    return points.succession(schools.unionByName(groups))


@register(QUERIES, SQL, """SELECT lang, 'text' AS "column", count(CASE WHEN trim(text) <> '' THEN 1 END) AS filled, count(*) AS of FROM documents GROUP BY lang
    UNION ALL SELECT lang, 'source', count(CASE WHEN trim(source) <> '' THEN 1 END), count(*) FROM documents GROUP BY lang""")
def fill_rates(spark, d):
    return readers.fill_rates(table(spark, d, "documents").select("lang", "text", "source"), "lang")


@register(QUERIES, SQL, """SELECT o_orderstatus, count(c_custkey) AS covered, count(*) AS of, round(CAST(100 AS DOUBLE) * count(c_custkey) / count(*), 2) AS pct FROM (SELECT DISTINCT o_orderstatus, o_custkey FROM orders)
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey % 4 <> 0) ON o_custkey = c_custkey GROUP BY o_orderstatus""")
def key_coverage(spark, d):
    return readers.key_coverage(table(spark, d, "orders"), "o_custkey", table(spark, d, "customer").filter("c_nationkey % 4 <> 0"), "c_custkey", "o_orderstatus")


@register(QUERIES, SQL, """SELECT n_name, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 3 THEN 'three' ELSE 'four' END AS region, part, n_regionkey || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code
    FROM (SELECT *, CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS part FROM nation) WHERE n_nationkey % 5 <> 3""")
def mapped_parts(spark, d):
    """A strict dictionary, parts under one another, a key of two columns, land only."""
    n = table(spark, d, "nation").select("n_name", "n_nationkey", "n_regionkey", F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("low"), F.col("n_regionkey").cast("string").alias("high"))
    n = readers.land(n.withColumns({"hcode": F.when(F.col("n_nationkey") % 10 == 3, "8154").otherwise("8101"), "kigo_d": F.when(F.col("n_nationkey") % 10 == 8, "D1").when(F.col("n_nationkey") % 10 == 1, "D")}))
    both = readers.tagged_union({"even": n.filter("n_nationkey % 2 = 0"), "odd": n.filter("n_nationkey % 2 = 1")}, ["even", "odd"], "part")
    mapped = readers.mapped(both, "n_regionkey", {0: "zero", 1: "one", 2: "two", 3: "three", 4: "four"}, "region")
    return mapped.select("n_name", "region", "part", readers.joined_key("high", "low").alias("code"))


@register(QUERIES, SQL, "SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) > 1 AS conflict FROM orders WHERE o_custkey IS NOT NULL")
def key_conflicts(spark, d):
    """Rows of repeated keys that have been reviewed, kept apart from the others."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey").filter("o_custkey IS NOT NULL")
    single, repeated = decisions.split_conflicts(o, ["o_custkey"], o.select("o_custkey"))
    return single.withColumn("conflict", F.lit(False)).unionByName(repeated.withColumn("conflict", F.lit(True)))


@register(QUERIES, SQL, f"""WITH {INPUTS} SELECT 'stops' AS bridge, count(*) AS n_rows, CAST(0 AS BIGINT) AS exact_count, CAST(0 AS BIGINT) AS equivalent_count, CAST(0 AS BIGINT) AS parent_count, CAST(0 AS BIGINT) AS child_count, CAST(0 AS BIGINT) AS overlap_count,
    count(*) FILTER (relation_type = 'ambiguous') AS ambiguous_count, count(*) FILTER (relation_type = 'unresolved') AS unresolved_count, count(*) FILTER (verification_status = 'auto') AS auto_count, count(*) FILTER (verification_status = 'review_required') AS review_required_count,
    CAST(0 AS BIGINT) AS manually_verified_count, CAST(0 AS BIGINT) AS manually_rejected_count, CAST(sum(candidate_count) AS BIGINT) AS candidate_count, CAST(0 AS DOUBLE) AS exact_pct,
    round(CAST(100 AS DOUBLE) * count(*) FILTER (relation_type = 'ambiguous') / count(*), 6) AS ambiguous_pct, round(CAST(100 AS DOUBLE) * count(*) FILTER (relation_type = 'unresolved') / count(*), 6) AS unresolved_pct FROM bridge""")
def bridge_measures(spark, d):
    """Counts and shares of the bridge of stops."""
    m = gates.bridge_measures(_bridge(spark, d), "stops")
    return m.withColumns({c: F.round(c, 6) for c in ("exact_pct", "ambiguous_pct", "unresolved_pct")})


@register(QUERIES, SQL, f"""WITH {INPUTS}, b AS (SELECT relation_type, match_method, verification_status, confidence FROM bridge)
    SELECT 'relation_type' AS measure, relation_type AS value, count(*) AS n FROM b GROUP BY 2 UNION ALL SELECT 'match_method', match_method, count(*) FROM b GROUP BY 2
    UNION ALL SELECT 'verification_status', verification_status, count(*) FROM b GROUP BY 2 UNION ALL SELECT 'confidence', CASE WHEN confidence = 1 THEN '0.9' ELSE '0.0' END, count(*) FROM b GROUP BY 2""")
def bridge_distributions(spark, d):
    return gates.bridge_distributions(_bridge(spark, d))


@register(QUERIES, SQL, """SELECT 'lineitem' AS source, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_returnflag)) AS n_keys, count(*) - count(DISTINCT (l_orderkey, l_returnflag)) AS n_duplicates, count(*) FILTER (l_linenumber = 3) AS line_nulls, CAST(0 AS BIGINT) AS key_nulls FROM lineitem""")
def source_nulls(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", F.nullif(F.col("l_linenumber"), F.lit(3)).alias("line"))
    m = gates.source_measures(rows, "lineitem", ["l_orderkey", "l_returnflag"])
    return m.select("source", "n_rows", "n_keys", "n_duplicates", F.col("nulls")["line"].alias("line_nulls"), F.col("nulls")["l_orderkey"].alias("key_nulls"))


def _sources(o, keep: str) -> DataFrame:
    return o.filter(keep).groupBy(F.col("o_orderstatus").alias("source")).agg(F.count("*").alias("n_rows"), (F.count("*") - F.countDistinct("o_custkey")).alias("n_duplicates"))


def _shares(o, bad: int, version: str) -> DataFrame:
    pct = lambda c: F.round(F.count_if(c) * 100.0 / F.count("*"), 4)
    k = F.col("o_orderkey")
    return o.groupBy(F.col("o_orderpriority").alias("bridge")).agg(F.lit(version).alias("rule_version"), pct(k % 10 >= bad).alias("exact_pct"), pct(k % 10 == 0).alias("ambiguous_pct"), pct((k % 10 > 0) & (k % 10 < bad)).alias("unresolved_pct"))


def _shares_sql(bad: int) -> str:
    pct = lambda c: f"round(CAST(100 AS DOUBLE) * count(*) FILTER ({c}) / count(*), 4)"
    return f"SELECT o_orderpriority AS bridge, {pct(f'o_orderkey % 10 >= {bad}')} AS e, {pct('o_orderkey % 10 = 0')} AS a, {pct(f'o_orderkey % 10 > 0 AND o_orderkey % 10 < {bad}')} AS u FROM orders GROUP BY 1"


@register(QUERIES, SQL, f"""WITH now_s AS (SELECT o_orderstatus AS s, count(*) AS n, count(*) - count(DISTINCT o_custkey) AS dup FROM orders GROUP BY 1),
    was_s AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders WHERE o_orderkey % 13 <> 0 GROUP BY 1), now_b AS ({_shares_sql(4)}), was_b AS ({_shares_sql(3)}),
    b AS (SELECT n.bridge, n.e - w.e AS e, n.a - w.a AS a, n.u - w.u AS u FROM now_b n JOIN was_b w USING (bridge)),
    t AS (SELECT count(*) FILTER (c_custkey % 50 <> 0) AS n, count(*) AS was, count(*) FILTER (c_custkey % 50 = 0 AND c_custkey % 100 <> 0) AS lost, count(*) FILTER (c_custkey % 100 = 0) AS retired FROM customer),
    m AS (SELECT 'source_rows_pct' AS metric, s AS subject, abs(CAST(100 AS DOUBLE) * (now_s.n - was_s.n) / was_s.n) AS value, 1 AS w, 5 AS f FROM now_s JOIN was_s USING (s) UNION ALL SELECT 'duplicate_keys', s, CAST(dup AS DOUBLE), 0, 0 FROM now_s
        UNION ALL SELECT 'required_source_missing', s, CASE WHEN s IN (SELECT s FROM now_s) THEN 0 ELSE 1 END, 0, 0 FROM (VALUES ('F'), ('O'), ('Z')) v(s)
        UNION ALL SELECT 'unresolved_rise', bridge, u, 1, 3 FROM b UNION ALL SELECT 'ambiguous_rise', bridge, a, 1, 3 FROM b UNION ALL SELECT 'exact_fall', bridge, -e, 1, 3 FROM b UNION ALL SELECT 'exact_rise', bridge, e, 1, 5 FROM b
        UNION ALL SELECT 'town_count_pct', 'towns', abs(CAST(100 AS DOUBLE) * (n - was) / was), 2, 2 FROM t UNION ALL SELECT 'removed_unexplained', 'towns', lost, 0, 0 FROM t UNION ALL SELECT 'retired_pct', 'towns', CAST(100 AS DOUBLE) * retired / was, 2, 2 FROM t
        UNION ALL SELECT 'invariant_failures', 'all', 0, 0, 0)
    SELECT metric, subject, round(value, 3) AS value, CASE WHEN metric = 'exact_fall' AND subject = '5-LOW' THEN 'approved' WHEN value > f THEN 'fail' WHEN value > w THEN 'warn' ELSE 'pass' END AS verdict FROM m""")
def release_gates(spark, d):
    """The release-blocking measures of two stand-in releases; the fall of one bridge's exact share is approved."""
    o, c, k = table(spark, d, "orders"), table(spark, d, "customer").select(F.col("c_custkey").alias("id")), F.col("id")
    now = {"sources": _sources(o, "true"), "bridges": _shares(o, 4, "2"), "towns": c.filter(k % 50 != 0), "explained": c.filter(k % 100 == 0)}
    before = {"sources": _sources(o, "o_orderkey % 13 <> 0"), "bridges": _shares(o, 3, "2"), "towns": c}
    versions = o.select(F.col("o_orderpriority").alias("subject"), F.lit("2").alias("old_version"), F.lit("2").alias("new_version")).distinct()
    approved = spark.createDataFrame([("5-LOW", "exact_fall", "2", "2", 10.0, 10.0), ("1-URGENT", "exact_fall", "1", "2", 10.0, 10.0)], "subject string, metric string, old_version string, new_version string, expected double, tolerance double")
    found = gates.release_gates(gates.release_measures(now, before, ["F", "O", "Z"]), approved, versions)
    return found.withColumn("value", F.round("value", 3))
