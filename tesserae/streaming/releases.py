"""Snapshots that arrive as a stream: each micro-batch is one release, carried forward into the version table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.versioning import carry_forward
from ..sources.readers import previous_release


def follow(snapshots: DataFrame, store: str, checkpoint: str, key: str, id_col: str, stamp_col: str = "observed_from"):
    """A streaming writer: the stamp of a batch is its latest ``stamp_col``. Each batch writes a version table of its own, ``release-<batch>``,
    from that of the batch before, so a batch that is run again gives the same table and a lost one damages nothing."""

    def release(batch: DataFrame, number: int):
        stamp = batch.agg(F.max(stamp_col)).first()[0]
        if stamp is None:
            stamp = ""
        before = None
        for n in range(number - 1, -1, -1):
            before = previous_release(batch.sparkSession, store, f"release-{n:09d}")
            if before is not None:
                break
        out = carry_forward(batch, before, key, id_col, stamp) if stamp or before is None else before
        out.write.mode("overwrite").parquet(f"{store}/release-{number:09d}.parquet")

    return snapshots.writeStream.foreachBatch(release).option("checkpointLocation", checkpoint)
