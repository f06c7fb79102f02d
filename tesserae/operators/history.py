"""Versions from release to release, without rewriting what is closed.

Open rows are a table bucketed and sorted by key; a release joins it where it lies. Rows that close are appended to another table, which no release reads again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import remove_folder
from .versioning import CLOCK, content_hash


class History:
    """Version rows in the tables ``<name>_open_<n>`` (n the number of the release) and ``<name>_closed`` of the session's catalog.

    Columns as ``carry_forward`` has them: key, content, id and clock columns; keys are unique and not NULL. ``buckets`` is fixed for good: it bounds the parallelism of a release, as a bucket is
    one task's work. Tables lie in ``folder``, which all executors share, or else in the session's warehouse. A release that failed half-way is done again: what it had written
    is removed first.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, id_col: str, buckets: int = 200, folder: str | None = None):
        self.spark, self.name, self.key, self.id_col, self.buckets, self.folder = spark, name, key, id_col, buckets, folder

    def _placed(self, writer, table: str):
        return writer.option("path", f"{self.folder}/{table}") if self.folder else writer

    def _open(self, release: int) -> str:
        return f"{self.name}_open_{release}"

    def _closed(self) -> str:
        return f"{self.name}_closed"

    def _write_open(self, rows: DataFrame, release: int) -> None:
        self.drop(release)
        # one file a bucket
        writer = rows.write.bucketBy(self.buckets, self.key).sortBy(self.key).format("parquet")
        self._placed(writer, self._open(release)).saveAsTable(self._open(release))

    def joined(self, current: DataFrame, release: int) -> DataFrame:
        """(p, c, same): each key's open row of the release before and its row of this one. The older side lies as the join wants it; only ``current`` is shuffled."""
        columns = current.columns
        content = [c for c in columns if c not in (*CLOCK, self.id_col, self.key)]
        held = self.spark.table(self._open(release - 1)).select(F.col(self.key).alias("k"), F.struct(*columns).alias("p"), content_hash(content).alias("ph"))
        new = current.repartition(self.buckets, self.key).select(F.col(self.key).alias("k"), F.struct(*columns).alias("c"), content_hash(content).alias("ch"))
        return held.join(new.hint("merge"), "k", "full_outer").select("p", "c", F.coalesce(F.col("ph") == F.col("ch"), F.lit(False)).alias("same"))

    def advance(self, current: DataFrame, release: int, stamp: str) -> None:
        """Take in a release: ``current`` holds its open rows, as for ``carry_forward``, whose rules hold."""
        columns = current.columns
        if release == 0:
            self._write_open(current.repartition(self.buckets, self.key), 0)
            return
        both = self.joined(current, release)
        end = F.greatest(F.lit(stamp), F.col("p.observed_from"))
        row = lambda side, changed: F.struct(*[changed.get(c, F.col(f"{side}.{c}")).alias(c) for c in columns])
        opened = row("c", {"observed_from": F.when(F.col("p").isNotNull(), end).otherwise(F.col("c.observed_from"))})
        shut = row("p", {"observed_to": end, "is_current": F.lit(False)})
        # a vanished row closes; one that stays as it was goes on; else the new one is open
        self._write_open(both.filter("c IS NOT NULL").select(F.when(F.col("same"), F.col("p")).otherwise(opened).alias("r")).select("r.*"), release)
        closing = both.filter("p IS NOT NULL AND NOT same").select(shut.alias("r")).select("r.*").withColumn("closed_in", F.lit(release))
        if self.spark.catalog.tableExists(self._closed()):
            self.spark.sql(f"ALTER TABLE {self._closed()} DROP IF EXISTS PARTITION (closed_in = {release})")
        if self.folder:
            remove_folder(self.spark, f"{self.folder}/{self._closed()}/closed_in={release}")
        self._placed(closing.write.partitionBy("closed_in").format("parquet").mode("append"), self._closed()).saveAsTable(self._closed())

    def rows(self, release: int) -> DataFrame:
        """All version rows as of a release."""
        now = self.spark.table(self._open(release))
        if not self.spark.catalog.tableExists(self._closed()):
            return now
        return now.unionByName(self.spark.table(self._closed()).filter(F.col("closed_in") <= release).select(*now.columns))

    def drop(self, release: int) -> None:
        """Remove the open rows of a release that no later one needs any more."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._open(release)}")
        if self.folder:
            remove_folder(self.spark, f"{self.folder}/{self._open(release)}")
