"""A release's tables as files that come out the same however the work was dealt out.

Every row's place in a total order is exact, so which rows make up file n depends on the rows alone. Executors write the files, each under a name of its own attempt; the manifest, which
lists one file for each number with its digest, is what commits them. No row passes the driver.
"""

from __future__ import annotations

import hashlib
import io
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import durable, forget
from ..errors import BuildError

_PLACES = ("part of the order", "place in the order", "file of the release")


def ranked(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with "place in the order", from 0, by the key and then all other columns, NULLs first. Equal rows, any number of them, have places next to each other. Only the
    number of rows of each part goes to the driver."""
    order = [*key, *[c for c in df.columns if c not in key]]
    columns = [F.col(f"`{c}`") for c in order]
    tied = df.withColumn("tie", F.monotonically_increasing_id()) if "tie" not in df.columns else df
    dealt = tied.repartitionByRange(*columns, F.col("tie")).sortWithinPartitions(*columns).select(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id().alias(_PLACES[0]))
    dealt = durable(dealt)  # parts, and the rows' places in them, now stand
    sizes, before = sorted(tuple(r) for r in dealt.groupBy(_PLACES[0]).count().collect()), {}
    upto = 0
    for part, n in sizes:
        before[part], upto = upto, upto + n
    starts = df.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], f"`{_PLACES[0]}` int, start long")
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = dealt.withColumn("within the part", within).join(F.broadcast(starts), _PLACES[0])  # a row a part
    return placed.withColumn(_PLACES[1], F.col("start") + F.col("within the part")).drop(_PLACES[0], "start", "within the part")


def _plain_path(uri: str) -> str:
    return uri.removeprefix("file://") if uri.startswith("file:///") else uri.removeprefix("file:") if uri.startswith("file:/") else uri


def _store(uri: str):
    """(file system, path) of a shared folder, on any executor; schemes as Arrow names them (s3, gs, hdfs, abfss) or s3a."""
    from pyarrow import fs

    uri = _plain_path(uri)
    uri = "s3" + uri[3:] if uri.startswith("s3a:") else uri
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _parquet(table: pa.Table, first: bool) -> bytes:
    import pyarrow.parquet as pq

    out = io.BytesIO()
    pq.write_table(table.replace_schema_metadata(None), out, compression="zstd", row_group_size=1 << 20)
    return out.getvalue()


def _csv_gz(table: pa.Table, first: bool) -> bytes:
    """A gzip member; the members of all files, one after the other, are one table with its header at the top."""
    import csv
    import gzip

    text, out = io.StringIO(), io.BytesIO()
    writer = csv.writer(text, lineterminator="\n")
    if first:
        writer.writerow(table.column_names)
    writer.writerows(zip(*[c.to_pylist() for c in table.columns], strict=True))
    with gzip.GzipFile("", "wb", 9, out, mtime=0) as z:
        z.write(text.getvalue().encode())
    return out.getvalue()


FORMATS = {"parquet": _parquet, "csv.gz": _csv_gz}


def write_release(df: DataFrame, folder: str, key: list[str], rows_per_file: int = 1_000_000, kind: str = "parquet") -> dict:
    """Write ``df`` to ``folder`` (shared by all executors) as files of ``rows_per_file`` rows; the manifest, which is also written there as manifest.json.

    The manifest's ``digest`` is that of the files' numbers and digests: equal rows give an equal digest, whatever the partitions, retries and machines. A task holds one file at a time.
    Files of attempts that did not count stay unlisted. An empty table has one file without rows.
    """
    encode = FORMATS[kind]
    numbered = ranked(df, key).withColumn(_PLACES[2], F.floor(F.col(_PLACES[1]) / rows_per_file))
    names = df.columns

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        store, top = _store(folder)
        store.create_dir(top, recursive=True)
        here, held = None, []

        def done():
            data = encode(pa.Table.from_batches(held), here == 0)
            name = f"part-{here:06d}-{task.taskAttemptId()}.{kind}"
            with store.open_output_stream(f"{top.rstrip('/')}/{name}", compression=None) as out:
                out.write(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([here], pa.int64()), pa.array([name]), pa.array([sum(map(len, held))], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([hashlib.sha256(data).hexdigest()])],
                names=["number", "name", "rows", "bytes", "sha256"],
            )

        for batch in batches:
            files = batch.column(_PLACES[2]).to_numpy()
            rows = batch.select(names)
            at = 0
            while at < len(files):
                end = at + int((files[at:] == files[at]).sum())
                if files[at] != here:
                    if here is not None:
                        yield done()
                    here, held = int(files[at]), []
                held.append(rows.slice(at, end - at))
                at = end
        if here is not None:
            yield done()

    dealt = numbered.repartition(_PLACES[2]).sortWithinPartitions(_PLACES[2], _PLACES[1])
    written = durable(dealt.mapInArrow(write, "number long, name string, rows long, bytes long, sha256 string"))
    files = [r.asDict() for r in written.orderBy("number").collect()]  # a row a file
    forget(written)
    store, top = _store(folder)
    store.create_dir(top, recursive=True)
    if not files:
        data, name = encode(df.limit(0).toArrow(), True), f"part-000000-none.{kind}"
        with store.open_output_stream(f"{top.rstrip('/')}/{name}", compression=None) as out:
            out.write(data)
        files = [{"number": 0, "name": name, "rows": 0, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}]
    told = "".join(f"{f['number']} {f['sha256']}\n" for f in files)
    manifest = {"kind": kind, "rows": sum(f["rows"] for f in files), "digest": hashlib.sha256(told.encode()).hexdigest(), "files": files}
    with store.open_output_stream(f"{top.rstrip('/')}/manifest.json", compression=None) as out:
        out.write(json.dumps(manifest, indent=1, sort_keys=True).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    store, top = _store(folder)
    with store.open_input_stream(f"{top.rstrip('/')}/manifest.json", compression=None) as f:
        return json.loads(f.read())


def check_release(spark: SparkSession, folder: str) -> None:
    """Every listed file is as it was written; each is read by an executor. Else CHECKSUM_MISMATCH."""
    rows = spark.createDataFrame([(f["name"], f["sha256"]) for f in read_manifest(folder)["files"]], "name string, sha256 string")

    def check(batches):
        store, top = _store(folder)
        for batch in batches:
            bad = []
            for name, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = hashlib.sha256()
                try:
                    with store.open_input_stream(f"{top.rstrip('/')}/{name}", compression=None) as f:
                        while data := f.read(1 << 20):
                            found.update(data)
                except FileNotFoundError:
                    found = hashlib.sha256(b"no file")
                if found.hexdigest() != digest:
                    bad.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["name"])

    bad = sorted(r.name for r in rows.repartition(spark.sparkContext.defaultParallelism).mapInArrow(check, "name string").collect())
    if bad:
        raise BuildError("CHECKSUM_MISMATCH", "files are not as they were written", files=bad[:5])


def read_release(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the listed files (Parquet)."""
    return spark.read.parquet(*[f"{folder}/{f['name']}" for f in read_manifest(folder)["files"]])
