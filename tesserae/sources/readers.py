"""Readers of frozen payloads as DataFrames of text, with the row's place in its file.

Files are listed and shipped by Spark (``binaryFile``); members are decoded on the executors, a file at a time. Codes stay text: nothing is inferred.
In place of a path, each reader takes a DataFrame of payloads (path, content).
"""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import BuildError
from .archives import Limits, check_magic, read_members
from .binary import read_dbf, read_doc, read_shp, read_xls, read_xlsx

PLACE = "source_file string, member string, row_ordinal long"


def _schema(columns: list[str]) -> str:
    return PLACE + "".join(f", `{c}` string" for c in columns)


def _files(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    files = path if isinstance(path, DataFrame) else spark.read.format("binaryFile").load(path)
    return files.select("path", "content")


def _decoded(spark: SparkSession, path: str | DataFrame, columns: list[str], rows_of) -> DataFrame:
    """``rows_of(content)`` gives (member, rows as lists)."""

    def run(frames):
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                for member, rows in rows_of(bytes(content)):
                    ordinal, width = 0, len(columns)
                    for i in range(0, len(rows), 10_000):
                        part = rows[i : i + 10_000]
                        bad = next((r for r in part if len(r) != width), None)
                        if bad is not None:
                            raise BuildError("SOURCE_SCHEMA_CHANGED", "a row of another width", file=file, member=member, found=len(bad), expected=width)
                        out = pd.DataFrame(part, columns=columns, dtype=object)
                        out.insert(0, "source_file", file)
                        out.insert(1, "member", member)
                        out.insert(2, "row_ordinal", range(ordinal, ordinal + len(part)))
                        ordinal += len(part)
                        yield out

    return _files(spark, path).mapInPandas(run, _schema(columns))


def _csv_rows(data: bytes, encoding: str, columns: list[str] | None, delimiter: str) -> list[list[str]]:
    rows = list(csv.reader(io.StringIO(data.decode(encoding), newline=""), delimiter=delimiter))
    if columns is not None:
        if not rows or rows[0] != columns:
            raise BuildError("SOURCE_SCHEMA_CHANGED", "another header", found=rows[:1], expected=columns)
        rows = rows[1:]
    return rows


def zip_csv(spark: SparkSession, path: str | DataFrame, columns: list[str], encoding: str = "utf-8-sig", header: bool = True, delimiter: str = ",", limits: Limits = Limits()) -> DataFrame:
    """CSV members of zip files. With ``header``, the first row must be ``columns``; without, each row must have as many fields."""
    return _decoded(spark, path, columns, lambda content: ((m, _csv_rows(d, encoding, columns if header else None, delimiter)) for m, d in read_members(content, ".csv", limits)))


def plain_csv(spark: SparkSession, path: str | DataFrame, columns: list[str], encoding: str = "utf-8-sig", header: bool = True, delimiter: str = ",") -> DataFrame:
    """CSV files in an encoding that the JVM's reader refuses (cp932 among them)."""
    return _decoded(spark, path, columns, lambda content: [("", _csv_rows(content, encoding, columns if header else None, delimiter))])


def dbf(spark: SparkSession, path: str | DataFrame, columns: list[str], encoding: str = "cp932", limits: Limits = Limits()) -> DataFrame:
    """dBASE members of zip files (archives in archives included); ``columns`` are the ones to keep, by name."""

    def rows_of(content):
        for member, data in read_members(content, ".dbf", limits):
            names, rows = read_dbf(data, encoding)
            missing = [c for c in columns if c not in names]
            if missing:
                raise BuildError("SOURCE_SCHEMA_CHANGED", "columns are missing", missing=missing)
            at = [names.index(c) for c in columns]
            yield member, [[r[i] for i in at] for r in rows]

    return _decoded(spark, path, columns, rows_of)


def shapes(spark: SparkSession, path: str | DataFrame, expect: int | None = None, limits: Limits = Limits()) -> DataFrame:
    """(source_file, member, row_ordinal, x0, y0, x1, y1, parts): shapes of zip files; a null shape keeps its place, with NULLs."""
    schema = PLACE + ", x0 double, y0 double, x1 double, y1 double, parts array<array<struct<x:double,y:double>>>"

    def run(frames):
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                for member, data in read_members(bytes(content), ".shp", limits):
                    rows = []
                    for i, shape in enumerate(read_shp(data, expect)):
                        box, parts = shape or ((None,) * 4, None)
                        rows.append((file, member, i, *box, parts and [[{"x": x, "y": y} for x, y in p] for p in parts]))
                    yield pd.DataFrame(rows, columns=["source_file", "member", "row_ordinal", "x0", "y0", "x1", "y1", "parts"])

    return _files(spark, path).mapInPandas(run, schema)


def table_rows(texts: DataFrame, columns: list[str]) -> DataFrame:
    """(source_file, member, row_ordinal, columns...) of the table in documents' texts (source_file, text): rows end in two U+0007, cells in one.

    A file's table reaches from its first to its last row of as many cells as there are columns; what lies around it is running text. No such row, or a row of another
    shape inside the table, is an error: leaving it out would lose data unseen. Ordinals count the table's rows from 0.
    """
    cell = lambda c: F.regexp_replace(c, r"^[\s\x00]+|[\s\x00]+$", "")
    parts = texts.select("source_file", F.posexplode(F.split("text", "\x07\x07")).alias("at", "part"))
    cells = parts.withColumn("cells", F.transform(F.split("part", "\x07"), cell))
    title = F.transform("cells", lambda c, i: F.when(i == 0, cell(F.substring_index(c, "\r", -1))).otherwise(c))  # a title stands before the first cell
    rows = cells.filter((F.size("cells") > 1) & (F.array_join("cells", "") != "")).select("source_file", "at", title.alias("cells"), (F.size("cells") == len(columns)).alias("fits"))
    fitting = F.when(F.col("fits"), F.col("at"))
    bounds = rows.groupBy("source_file").agg(F.min(fitting).alias("first"), F.max(fitting).alias("last"))
    files = texts.select("source_file").join(bounds, "source_file", "left")

    def stop(message):
        return F.raise_error(F.concat(F.lit("[SOURCE_FETCH_FAILED] "), F.col("source_file"), F.lit(f": {message}"))).cast("boolean")

    # checks stand in filters, so that they are made whichever columns are asked for
    inside = F.col("at").between(F.col("first"), F.col("last"))
    table = rows.join(bounds, "source_file").filter(F.when(inside & ~F.col("fits"), stop("a row of another shape inside the table")).otherwise(F.coalesce(inside, F.lit(False))))
    ordinal = F.row_number().over(W.partitionBy("source_file").orderBy("at")).cast("long") - 1
    table = table.select("source_file", F.lit("").alias("member"), ordinal.alias("row_ordinal"), *[F.element_at("cells", i + 1).alias(c) for i, c in enumerate(columns)])
    none = files.filter(F.when(F.col("first").isNull(), stop("no row has the expected cells")).otherwise(F.lit(False)))
    return table.unionByName(none.select("source_file"), allowMissingColumns=True)


def word_table(spark: SparkSession, path: str | DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the table in Word 97 documents."""

    def run(frames):
        for frame in frames:
            texts = []
            for content in frame["content"]:
                check_magic("doc", bytes(content))
                texts.append(read_doc(bytes(content)))
            yield pd.DataFrame({"source_file": frame["path"], "text": pd.Series(texts, dtype=object)})

    return table_rows(_files(spark, path).mapInPandas(run, "source_file string, text string"), columns)


def _sheet_rows(cells: list[list], width: int, notes: bool) -> list[list]:
    """The rows of a sheet's table, filled to its width. Blank rows may only follow it: a row after a blank one is an error, unless footnotes are expected (then those
    whose cells beyond the first are blank are left out), and so is a filled cell beyond the width."""
    last = max((i for i, r in enumerate(cells) if any(r) and not (notes and not any(r[1:]))), default=-1)
    rows = cells[: last + 1]
    for i, r in enumerate(rows):
        if not any(r) or any(r[width:]):
            raise BuildError("SOURCE_SCHEMA_CHANGED", "a blank row inside the table, or cells beyond its columns", row=i, cells=len(r), expected=width)
    rest = [i for i, r in enumerate(cells[last + 1 :], last + 1) if any(r)]
    if rest and not notes:
        raise BuildError("SOURCE_SCHEMA_CHANGED", "rows after the table", row=rest[0])
    return [(r + [None] * width)[:width] for r in rows]


def xlsx_table(spark: SparkSession, path: str | DataFrame, columns: list[str], first_row: int, sheet: int = 1, notes: bool = False) -> DataFrame:
    """Rows of a worksheet from ``first_row`` (from 1) on, to its last one that is not blank; missing cells are NULL. A blank row inside, or a filled cell beyond
    the columns, is an error. ``notes``: footnotes, which fill the first cell only, may follow."""

    def rows_of(content):
        check_magic("xlsx", content)
        return [("", _sheet_rows(read_xlsx(content, sheet)[first_row - 1 :], len(columns), notes))]

    return _decoded(spark, path, columns, rows_of)


def xls_table(spark: SparkSession, path: str | DataFrame, columns: list[str], first_row: int, sheet: str, notes: bool = False) -> DataFrame:
    """Rows of a named sheet of BIFF8 workbooks; as ``xlsx_table``."""

    def rows_of(content):
        check_magic("xls", content)
        return [("", _sheet_rows(read_xls(content, sheet)[first_row - 1 :], len(columns), notes))]

    return _decoded(spark, path, columns, rows_of)


def mapped(df: DataFrame, column: str, pairs: dict, out: str) -> DataFrame:
    """``df`` with ``out``: what the value of ``column`` stands for in a dictionary. A value that the dictionary lacks is an error, NULL included."""
    table = df.sparkSession.createDataFrame([(str(k), str(v)) for k, v in pairs.items()] or [("", "")], "`the key` string, `the value` string")
    joined = df.join(F.broadcast(table), F.col(column).cast("string") == F.col("the key"), "left")
    told = F.concat(F.lit(f"[SOURCE_SCHEMA_CHANGED] {column} has an unknown value: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
    value = F.when(F.col("the key").isNull(), F.raise_error(told)).otherwise(F.col("the value"))
    return joined.withColumn(out, value).drop("the key", "the value")


def land(df: DataFrame, kind: str = "hcode", mark: str = "kigo_d") -> DataFrame:
    """Boundary rows that are land. Kind 8101 is land, 8154 water; the mark D1 is water too, D is land."""
    return df.filter((F.col(kind) == "8101") & ~F.coalesce(F.col(mark) == "D1", F.lit(False)))


def joined_key(*parts: str):
    """A key made of columns, one after the other; NULL if any is."""
    return F.concat(*[F.col(p) for p in parts])


def tagged_union(parts: dict[str, DataFrame], required: list[str], tag: str) -> DataFrame:
    """All parts under one another with the part's name in ``tag``; a missing part is an error, not a smaller table."""
    missing = [k for k in required if k not in parts]
    if missing:
        raise BuildError("REQUIRED_SOURCE_MISSING", "not all parts are there", missing=missing)
    out = None
    for k in required:
        df = parts[k].withColumn(tag, F.lit(k))
        out = df if out is None else out.unionByName(df)
    return out


def previous_release(spark: SparkSession, folder: str | None, name: str) -> DataFrame | None:
    """A table of the last release; None if there is none."""
    if folder is None:
        return None
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    there = place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)
    return spark.read.parquet(f"{folder}/{name}.parquet") if there else None


def ledger(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A gzip CSV of text columns; leading zeros are data."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def snapshots(spark: SparkSession, path: str | DataFrame, source: str, rows: DataFrame | None = None) -> DataFrame:
    """(source_snapshot_id, source, path, sha256, size[, row_count]): what was read, by content; sums of the files are taken by Spark."""
    files = _files(spark, path).select("path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("size"))
    out = files.select(F.concat(F.lit("snp_"), F.substring("sha256", 1, 16)).alias("source_snapshot_id"), F.lit(source).alias("source"), "path", "sha256", "size")
    if rows is None:
        return out
    return out.join(rows.groupBy(F.col("source_file").alias("path")).agg(F.count("*").alias("row_count")), "path", "left").fillna(0, ["row_count"])


def fill_rates(df: DataFrame, by: str) -> DataFrame:
    """(by, column, filled, of): how many cells of each column are not blank."""
    columns = [c for c in df.columns if c != by]
    counts = df.groupBy(by).agg(F.count("*").alias("of"), *[F.count_if(F.trim(F.col(c)) != "").alias(c) for c in columns])
    return counts.unpivot([by, "of"], columns, "column", "filled").select(by, "column", "filled", "of")


def key_coverage(df: DataFrame, key: str, parent: DataFrame, parent_key: str, by: str) -> DataFrame:
    """(by, covered, of, pct): how many distinct keys of ``df`` the other table has; NULL keys are not counted."""
    there = parent.select(F.col(parent_key).alias(key), F.lit(True).alias("there")).distinct()
    keys = df.select(by, key).filter(F.col(key).isNotNull()).distinct().join(there, key, "left")
    covered = F.count("there")
    return keys.groupBy(by).agg(covered.alias("covered"), F.count("*").alias("of"), F.round(covered * 100.0 / F.count("*"), 2).alias("pct"))
