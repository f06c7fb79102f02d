"""Outputs of a release. Equal tables give equal bytes: rows in a total order, no clock in any file."""

from __future__ import annotations

import csv
import gzip
import io
import json
import os
import sqlite3
import zipfile

import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import BuildError

#: Rows that an output may have if it is written as one file by the driver.
ONE_FILE_ROWS = 5_000_000


def _rows(df: DataFrame, key: list[str], most: int = ONE_FILE_ROWS):
    """All rows in order of the key, as Arrow; an error beyond the bound (write those with ``write_parquet``)."""
    n = df.limit(most + 1).count()
    if n > most:
        raise BuildError("ROW_COUNT_ANOMALY", "too many rows for one file", most=most)
    return df.orderBy(*key, *[c for c in df.columns if c not in key]).toArrow()


def write_parquet(df: DataFrame, path: str, key: list[str], files: int | None = None) -> None:
    """A table of any size: ranges of the key, sorted within."""
    out = df.repartitionByRange(files, *key) if files else df.repartitionByRange(*key)
    out.sortWithinPartitions(*key).write.mode("overwrite").parquet(path)


def write_parquet_file(df: DataFrame, path: str, key: list[str]) -> None:
    """One file with the same bytes for the same rows."""
    table = _rows(df, key).replace_schema_metadata(None)
    pq.write_table(table, path, compression="zstd", row_group_size=1 << 20)


def _gzip(data: bytes) -> bytes:
    out = io.BytesIO()
    with gzip.GzipFile("", "wb", 9, out, mtime=0) as z:
        z.write(data)
    return out.getvalue()


def write_csv_gz(df: DataFrame, path: str, key: list[str]) -> None:
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n")
    writer.writerow(df.columns)
    writer.writerows(list(r.values()) for r in _rows(df, key).to_pylist())
    with open(path, "wb") as f:
        f.write(_gzip(text.getvalue().encode()))


def write_csv(df: DataFrame, path: str, key: list[str]) -> None:
    """A small report; the header alone if there are no rows."""
    with open(path, "w", encoding="utf-8", newline="") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(df.columns)
        writer.writerows(list(r.values()) for r in _rows(df, key).to_pylist())


def write_zip(files: dict[str, bytes], path: str) -> None:
    """Members in the order of their names, with fixed times."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
        for name in sorted(files):
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), files[name], zipfile.ZIP_DEFLATED)


def write_points(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]]) -> None:
    """Coordinates go into an archive of their own; without points there is no archive, and an old one goes."""
    files = {}
    for name, df in tables.items():
        table = _rows(df, keys[name])
        if len(table):
            out = io.BytesIO()
            pq.write_table(table.replace_schema_metadata(None), out, compression="zstd")
            files[f"{name}.parquet"] = out.getvalue()
    if files:
        write_zip(files, path)
    elif os.path.exists(path):
        os.remove(path)


# A column's type in SQLite; others are written as text (dates and times in ISO form, decimals in full, nested values as JSON).
SQLITE = {"string": "TEXT", "bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}


def _for_sqlite(df: DataFrame) -> DataFrame:
    """Columns that SQLite has no type for, as text."""
    nested = ("array", "map", "struct")
    return df.select(*[F.col(f"`{c}`") if t in SQLITE else (F.to_json(f"`{c}`") if t.startswith(nested) else F.col(f"`{c}`").cast("string")).alias(c) for c, t in df.dtypes])


def write_sqlite_gz(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]], checks: dict[str, list[str]] | None = None, foreign: dict[str, list[tuple[str, str, str]]] | None = None) -> None:
    """All tables in a gzip SQLite file. ``checks`` are CHECK constraints; ``foreign`` are (column, table, column there), whose target is the other table's
    key. A row that breaks one stops the export. The plain file is not kept."""
    con = sqlite3.connect(":memory:")
    targets = {t: sorted({c for rows in (foreign or {}).values() for _, t2, c in rows if t2 == t}) for t in tables}
    for name in sorted(tables):
        df = _for_sqlite(tables[name])
        columns = [f'"{c}" {SQLITE[t]}' for c, t in df.dtypes] + [f"CHECK ({c})" for c in (checks or {}).get(name, [])]
        columns += [f'UNIQUE ("{c}")' for c in targets[name]] + [f'FOREIGN KEY ("{c}") REFERENCES "{t}" ("{there}")' for c, t, there in (foreign or {}).get(name, [])]
        con.execute(f'CREATE TABLE "{name}" ({", ".join(columns)})')
        try:
            con.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(df.columns))})', (list(r.values()) for r in _rows(df, keys[name]).to_pylist()))
        except sqlite3.IntegrityError as e:
            raise BuildError("VALIDATION_FAILED", f"a row of {name} breaks a constraint", reason=str(e)) from e
    con.commit()
    lost = con.execute("PRAGMA foreign_key_check").fetchall()
    if lost:
        raise BuildError("VALIDATION_FAILED", "rows without the row that they name", tables=sorted({(r[0], r[2]) for r in lost}), rows=len(lost))
    data = con.serialize()
    with open(path, "wb") as f:
        f.write(_gzip(data))


def write_tables_zip(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]]) -> None:
    """All tables as Parquet in one archive, in the order of their names."""
    files = {}
    for name, df in tables.items():
        out = io.BytesIO()
        pq.write_table(_rows(df, keys[name]).replace_schema_metadata(None), out, compression="zstd")
        files[f"{name}.parquet"] = out.getvalue()
    write_zip(files, path)


def write_diff(diff: dict, folder: str) -> None:
    """The release's differences as JSON with sorted keys and as Markdown."""
    with open(f"{folder}/diff.json", "w", encoding="utf-8") as f:
        json.dump(diff, f, ensure_ascii=False, indent=2, sort_keys=True)
    with open(f"{folder}/diff.md", "w", encoding="utf-8") as f:
        f.write("# Differences\n\n| what | value |\n|---|---|\n" + "".join(f"| {k} | {diff[k]} |\n" for k in sorted(diff)))


def review_queue(bridge: DataFrame, group: str = "candidate_group_id") -> DataFrame:
    """Rows that a person can act on (candidates to choose from), the largest groups first."""
    rows = bridge.filter((F.col("verification_status") == "review_required") & (F.col("candidate_count") > 1))
    return rows.orderBy(F.desc("candidate_count"), group)


def bus_chunks(stops: DataFrame) -> DataFrame:
    """(mesh, chunk): the stops of a square as JSON, ``[name, [operators], x, y]`` in order; from mesh, name, operator, x, y."""
    places = stops.groupBy("mesh", "name", "x", "y").agg(F.array_sort(F.collect_set("operator")).alias("operators"))
    rows = places.groupBy("mesh").agg(F.array_sort(F.collect_list(F.struct("name", "operators", "x", "y"))).alias("rows"))
    row = F.transform("rows", lambda r: F.concat(F.lit("["), F.to_json(F.array(r["name"])).substr(F.lit(2), F.length(F.to_json(F.array(r["name"]))) - 2), F.lit(","), F.to_json(r["operators"]), F.lit(","), r["x"].cast("string"), F.lit(","), r["y"].cast("string"), F.lit("]")))
    return rows.select("mesh", F.concat(F.lit("["), F.array_join(row, ","), F.lit("]")).alias("chunk"))
