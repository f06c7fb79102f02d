"""Distributed running sums: along a total order, or along the order of each group.

Rows are dealt out by ranges of the order, sorted, and made durable once. Of each part only its number of rows, its sums and its first and last group go to
the driver; every part then starts from what stands before it. A group of any size is spread over parts, and no task holds more than an Arrow batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ._common import durable, named

_PART = "part of the scan"


def _unsigned(column) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False)).astype(np.int64, copy=False).view(np.uint64)


def running(values: np.ndarray, first: np.ndarray, segment: np.ndarray, carried) -> np.ndarray:
    """Inclusive sums of unsigned values, modulo 2**64, which begin anew at the places ``first``; the first segment goes on from ``carried``."""
    upto = np.cumsum(values, dtype=np.uint64)
    before = np.concatenate((np.zeros(1, np.uint64), upto))[first]
    before[0] -= np.uint64(carried)
    return upto - before[segment]


def _segments(batch, group: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of the rows, places where a new one begins, and the number of each row's segment."""
    groups = _unsigned(batch.column(group)) if group else np.zeros(len(batch), np.uint64)
    change = np.concatenate(([True], groups[1:] != groups[:-1]))
    return groups, np.flatnonzero(change), np.cumsum(change) - 1


class Scan:
    """Rows in order, with ``index`` (from 1 in each group) and the running sums of ``weigh``.

    ``group``: a long column without nulls, the first of ``order``, at whose changes indexes and sums begin anew; None: never. ``weigh``: from the index
    and a function that gives a batch's integer column by name, unsigned, to the arrays that are summed, modulo 2**64. ``deal``: by what to deal out the ranges,
    where that is not ``order`` itself; equal values of it stay together. ``drop``: columns of the order that are not kept.
    """

    def __init__(self, df: DataFrame, order: list[str], group: str | None = None, weigh=None, sums: tuple[str, ...] = (), drop: tuple[str, ...] = (), deal: list | None = None):
        placed = df.repartitionByRange(*(deal or [named(c) for c in order])).sortWithinPartitions(*[named(c) for c in order])
        self.group, self.weigh, self.sums = group, weigh, sums
        self.table = durable(placed.withColumn(_PART, F.spark_partition_id().cast("long")).drop(*drop))
        #: by part: the last group before it, and the index or the sums reached there
        self.index_before: dict[int, tuple] = {}
        self.sums_before: dict[int, tuple] = {}
        self.index_before = self._before(counted=True)
        if sums:
            self.sums_before = self._before(counted=False)

    def _walker(self, summing: bool):
        group, weigh, width, index_before, sums_before = self.group, self.weigh, len(self.sums), self.index_before, self.sums_before

        def walk(batches):
            """(batch, groups, index, weights, sums) of each batch of a part."""
            begun = False
            for batch in batches:
                if not len(batch):
                    continue
                if not begun:
                    part = batch.column(_PART)[0].as_py()
                    counted, summed, begun = index_before.get(part), sums_before.get(part), True
                groups, first, segment = _segments(batch, group)
                head, tail = int(groups[0]), int(groups[-1])
                index = running(np.ones(len(batch), np.uint64), first, segment, counted[1][0] if counted and counted[0] == head else 0)
                counted = (tail, [int(index[-1])])
                weights, totals = [], []
                if summing:
                    weights = weigh(index, lambda name, batch=batch: _unsigned(batch.column(name)))
                    carried = summed[1] if summed and summed[0] == head else [0] * width
                    totals = [running(w, first, segment, c) for w, c in zip(weights, carried, strict=True)]
                    summed = (tail, [int(t[-1]) for t in totals])
                yield batch, groups, index, weights, totals

        return walk

    def _before(self, counted: bool) -> dict[int, tuple]:
        walk = self._walker(not counted)

        def run(batches):
            found = None
            for batch, groups, index, _, totals in walk(batches):
                head = found[1] if found else int(groups[0])
                found = [batch.column(_PART)[0].as_py(), head, int(groups[-1]), *[int(t[-1]) for t in ([index] if counted else totals)]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([[str(x) for x in found]], pa.list_(pa.string()))], names=["state"])

        before, out = None, {}
        for part, head, tail, *values in sorted([int(x) for x in r[0]] for r in self.table.mapInArrow(run, "state array<string>").collect()):
            if before:
                out[part] = before
                if head == tail and before[0] == head:  # one group fills the part, and came from before
                    values = [(v + b) % 2**64 for v, b in zip(values, before[1], strict=True)]
            before = (tail, values)
        return out

    def rows(self, *weights: str) -> DataFrame:
        """The columns of the input, ``index`` and the sums; ``weights`` names the weights themselves, to be added too."""
        walk = self._walker(bool(self.sums))
        kept = [f for f in self.table.schema.fields if f.name != _PART]
        names = ["index", *self.sums, *weights]

        def run(batches):
            for batch, _, index, weighed, totals in walk(batches):
                added = [pa.array(x.view(np.int64)) for x in (index, *totals, *(weighed if weights else []))]
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *added], names=[*[f.name for f in kept], *names])

        return self.table.mapInArrow(run, StructType([*kept, *[StructField(n, LongType()) for n in names]]))
