"""Geometry chunks: unsigned varints, zig-zag differences, units of a millionth of a degree from the chunk's origin."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNITS = 1_000_000


def varints(values) -> bytes:
    """LEB128 of numbers from 0 on: seven bits a byte, the lowest first."""
    out = bytearray()
    for v in values:
        while v > 127:
            out.append(v % 128 + 128)
            v //= 128
        out.append(v)
    return bytes(out)


def unvarints(data: bytes) -> list[int]:
    out, value, shift = [], 0, 0
    for b in data:
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(value)
            value = shift = 0
    if shift:
        raise ValueError("a number cut short")
    return out


def quantised(points, origin: tuple[float, float], closed: bool) -> np.ndarray | None:
    """Whole units from the origin (halves to even), without points that repeat the one before; rings are left open. Fewer than three (ring) or two (line): None."""
    if not len(points):
        return None
    q = np.rint((np.asarray(points, float) - origin) * UNITS).astype(np.int64)
    q = q[np.append(True, (q[1:] != q[:-1]).any(axis=1))]
    if closed and len(q) > 1 and (q[0] == q[-1]).all():
        q = q[:-1]
    return q if len(q) >= (3 if closed else 2) else None


def path_numbers(q: np.ndarray) -> list[int]:
    """Count, then the zig-zag differences of x and y in turn."""
    steps = np.diff(q, axis=0, prepend=0).ravel()
    return [len(q), *np.where(steps >= 0, 2 * steps, -2 * steps - 1).tolist()]


def pack_cells(cells, origin: tuple[float, float]) -> bytes:
    """``cells``: (code, [(unit, rings)]). What vanishes when quantised is left out, cells with nothing left, too."""
    out, n = [], 0
    for code, pieces in cells:
        kept = []
        for unit, rings in pieces:
            paths = [q for r in rings if (q := quantised(r, origin, True)) is not None]
            if paths:
                kept += [unit, len(paths), *(v for q in paths for v in path_numbers(q))]
                kept.append(None)
        if kept:
            n += 1
            out += [code, kept.count(None), *(v for v in kept if v is not None)]
    return varints([n, *out])


def pack_lines(lines, origin: tuple[float, float]) -> bytes:
    kept = [(unit, q) for unit, points in lines if (q := quantised(points, origin, False)) is not None]
    return varints([len(kept), *(v for unit, q in kept for v in (unit, *path_numbers(q)))])


class _Numbers:
    def __init__(self, data: bytes, origin):
        self.values, self.at, self.origin = unvarints(data), 0, origin

    def next(self) -> int:
        self.at += 1
        return self.values[self.at - 1]

    def path(self) -> list[tuple[float, float]]:
        n = self.next()
        steps = np.array(self.values[self.at : self.at + 2 * n], np.int64)
        self.at += 2 * n
        q = np.where(steps % 2 == 0, steps // 2, -(steps + 1) // 2).reshape(-1, 2).cumsum(axis=0)
        return [tuple(p) for p in (q / UNITS + self.origin).tolist()]

    def end(self):
        if self.at != len(self.values):
            raise ValueError("numbers are left over")


def unpack_cells(data: bytes, origin: tuple[float, float]):
    r = _Numbers(data, origin)
    out = [(r.next(), [(r.next(), [r.path() for _ in range(r.next())]) for _ in range(r.next())]) for _ in range(r.next())]
    r.end()
    return out


def unpack_lines(data: bytes, origin: tuple[float, float]):
    r = _Numbers(data, origin)
    out = [(r.next(), r.path()) for _ in range(r.next())]
    r.end()
    return out


def pack_chunks(pieces: DataFrame) -> DataFrame:
    """(chunk, data binary) from (chunk, ox, oy, code long, unit long, rings): a group is one chunk, whose area bounds its size."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["code", "unit"], kind="stable")
        origin = (frame["ox"].iloc[0], frame["oy"].iloc[0])
        point = lambda p: (p["x"], p["y"])
        cells = [(int(code), [(int(u), [[point(p) for p in ring] for ring in rings]) for u, rings in zip(g["unit"], g["rings"], strict=True)]) for code, g in frame.groupby("code")]
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "data": [pack_cells(cells, origin)]})

    return pieces.groupBy("chunk").applyInPandas(pack, "chunk string, data binary")


def unpack_chunks(chunks: DataFrame) -> DataFrame:
    """(chunk, code, unit, piece, ring, points): the rings of packed chunks (chunk, ox, oy, data); pieces are counted in their cell, rings in their piece, from 0."""

    def unpack(frames):
        for frame in frames:
            for chunk, ox, oy, data in zip(frame["chunk"], frame["ox"], frame["oy"], frame["data"], strict=True):
                cells = unpack_cells(bytes(data), (ox, oy))
                rows = [(chunk, code, unit, n, k, [{"x": x, "y": y} for x, y in ring]) for code, pieces in cells for n, (unit, rings) in enumerate(pieces) for k, ring in enumerate(rings)]
                yield pd.DataFrame(rows, columns=["chunk", "code", "unit", "piece", "ring", "points"])

    return chunks.select("chunk", "ox", "oy", "data").mapInPandas(unpack, "chunk string, code long, unit long, piece int, ring int, points array<struct<x:double,y:double>>")


def chunk_scripts(chunks: DataFrame, kind: str, call: str = "chunks.put") -> DataFrame:
    """(chunk, script): a chunk (chunk, data) as a line of script that hands its bytes, in base64, to ``call``, so that a page can load it from a file."""
    body = F.regexp_replace(F.base64("data"), r"\s", "")
    return chunks.select("chunk", F.concat(F.lit(f'{call}("{kind}","'), "chunk", F.lit('","'), body, F.lit('");\n')).alias("script"))
