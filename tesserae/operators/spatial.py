"""Points, lines and polygons as columns: containment joins over a grid, placement points, bridges.

A ring is ``array<struct<x:double,y:double>>``, a shape has ``rings`` (holes included), a line has ``parts``. Everything is
built-in expressions; no geometry crosses to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..durable import durable


def in_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd containment over all rings. An edge counts if exactly one of its ends lies above the point (half-open, so a
    vertex on the ray counts once) and it crosses to the right of it. Rings of fewer than three points are skipped."""

    def crossings(ring):
        def crosses(i):
            b = F.element_at(ring, i)
            a = F.element_at(ring, F.when(i == 1, F.size(ring)).otherwise(i - 1))
            at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
            return ((a["y"] > y) != (b["y"] > y)) & F.coalesce(x < at, F.lit(False))

        return F.when(F.size(ring) < 3, 0).otherwise(F.size(F.filter(F.sequence(F.lit(1), F.size(ring)), crosses)))

    return F.aggregate(rings, F.lit(0), lambda n, ring: n + crossings(ring)) % 2 == 1


def with_box(shapes: DataFrame) -> DataFrame:
    """``x0, y0, x1, y1`` of the rings."""
    xs, ys = F.transform(F.flatten("rings"), lambda p: p["x"]), F.transform(F.flatten("rings"), lambda p: p["y"])
    return shapes.withColumns({"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)})


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size)))


def grid_candidates(points: DataFrame, boxes: DataFrame, cell: tuple[float, float] = (0.05, 0.05)) -> DataFrame:
    """All pairs of a point (``x``, ``y``) and a box that holds it, borders included: an equi-join on grid cells, then the box test.

    Points without coordinates meet nothing. Columns of both sides are kept; ``boxes`` should not carry rings, so that they stay out of
    the shuffle. A cell with many points is split by adaptive execution (the join shuffles both sides for itself).
    """
    steps = [F.sequence(_cell(F.col(f"{c}0"), s), _cell(F.col(f"{c}1"), s)) for c, s in zip("xy", cell, strict=True)]
    cells = boxes.withColumn("cx", F.explode(steps[0])).withColumn("cy", F.explode(steps[1]))
    placed = points.withColumns({"cx": _cell(F.col("x"), cell[0]), "cy": _cell(F.col("y"), cell[1])})
    held = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    return placed.join(cells, ["cx", "cy"]).filter(held).drop("cx", "cy")


def ring_edges(rings: Column) -> Column:
    """All edges (ax, ay, bx, by) of the rings, each from a point to the next, the last one closing its ring. Rings of fewer than three points have none."""

    def of(ring):
        n = F.size(ring)
        before = F.concat(F.slice(ring, n, F.lit(1)), F.slice(ring, F.lit(1), n - 1))
        edge = lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))
        return F.zip_with(before, ring, edge)

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 3), of))


def touched_cells(edges: DataFrame, cell: tuple[float, float], *keep: str) -> DataFrame:
    """(keep..., cell x, cell y, crossings): the grid cells that edges (ax, ay, bx, by) touch, row by row, and how many of them cross the middle line of the row in that
    cell. An edge is widened by a billionth of a cell and what rounding may come to, so that none is left out; ``keep`` names what tells shapes apart."""
    w, h = map(float, cell)
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edges.withColumn("cell y", F.explode(F.sequence(_cell(low, h), _cell(high, h))))
    slope = (F.col("bx") - F.col("ax")) / F.nullif(F.col("by") - F.col("ay"), F.lit(0.0))
    at = lambda y: F.col("ax") + (y - F.col("ay")) * slope
    ends = [at(F.greatest(low, F.col("cell y") * h)), at(F.least(high, (F.col("cell y") + 1) * h))]
    flat = F.col("ay") == F.col("by")
    left, right = (F.when(flat, pick("ax", "bx")).otherwise(pick(*ends)) for pick in (F.least, F.greatest))
    wide = F.greatest(F.abs("ax"), F.abs("bx")) * 1e-13 + w * 1e-9
    middle = (F.col("cell y") + 0.5) * h
    rows = rows.withColumns({"from": _cell(left - wide, w), "to": _cell(right + wide, w), "crosses": (F.col("ay") > middle) != (F.col("by") > middle)})
    rows = rows.withColumn("crossing", F.when(F.col("crosses"), F.greatest(F.col("from"), F.least(F.col("to"), _cell(at(middle), w)))))
    cells = rows.select(*keep, "cell y", "crossing", F.explode(F.sequence("from", "to")).alias("cell x"))
    return cells.groupBy(*keep, "cell x", "cell y").agg(F.count_if(F.col("crossing") == F.col("cell x")).alias("crossings"))


def covering(shapes: DataFrame, cell: tuple[float, float]) -> tuple[DataFrame, DataFrame]:
    """Cells of ``shapes`` (shape_id, code, rings) and the edges that settle points of their borders.

    Cells: (shape_id, code, scale, cell x, cell y, inside); those that no edge touches are wholly inside, or left out. Edges: (shape_id, band, edges), by bands of y, of
    which ``scale`` make a unit. A shape's bands are as high as its edges on average, so all its bands together hold at most two rows for each edge.
    """
    rows = shapes.select("shape_id", "code", ring_edges(F.col("rings")).alias("edges"))
    height = F.aggregate("edges", F.lit(0.0), lambda s, e: s + F.coalesce(F.abs(e["by"] - e["ay"]), F.lit(0.0)))
    rows = rows.withColumn("scale", F.when(height > 0, F.size("edges") / height).otherwise(0.0))
    edges = rows.select("shape_id", "code", "scale", F.explode("edges").alias("e")).select("shape_id", "code", "scale", "e.*")
    border = touched_cells(edges, cell, "shape_id", "code", "scale")
    # between two border cells of a row lie cells of one kind: inside, if an odd number of edges crosses the row's middle further on
    row = W.partitionBy("shape_id", "cell y").orderBy(F.col("cell x").desc())
    beyond = F.coalesce(F.sum("crossings").over(row.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    gaps = border.withColumns({"next": F.lag("cell x").over(row), "odd": beyond % 2 == 1}).filter(F.col("odd") & (F.col("next") > F.col("cell x") + 1))
    inner = gaps.select("shape_id", "code", "scale", F.explode(F.sequence(F.col("cell x") + 1, F.col("next") - 1)).alias("cell x"), "cell y", F.lit(True).alias("inside"))
    cells = inner.unionByName(border.drop("crossings").withColumn("inside", F.lit(False)))
    banded = edges.filter("ay <> by").withColumn("band", F.explode(F.sequence(F.floor(F.least("ay", "by") * F.col("scale")), F.floor(F.greatest("ay", "by") * F.col("scale")))))
    return cells, banded.groupBy("shape_id", "band").agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("edges"))


def crosses_right(x: Column, y: Column, e: Column) -> Column:
    """Whether an edge counts for a point: exactly one of its ends lies above (half-open), and it crosses to the right."""
    at = e["ax"] + (y - e["ay"]) * (e["bx"] - e["ax"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0))
    return ((e["ay"] > y) != (e["by"] > y)) & F.coalesce(x < at, F.lit(False))


#: Cells, and edges, of shapes that may be broadcast.
FEW = 500_000


def containment_join(points: DataFrame, shapes: DataFrame, cell: tuple[float, float] = (0.05, 0.05)) -> DataFrame:
    """Pairs of ``points`` (``x``, ``y``, ...) and ``shapes`` (``shape_id``, ``code``, ``rings``) that hold them: columns of the points, and ``code``.

    A point meets the cells of its place. A cell wholly inside a shape settles it; in a border cell, it meets the edges of its band of y (an equi-join) and the parity
    of those that it crosses decides, by the rule of ``in_rings``. No ring ever stands beside a point. ``shape_id`` is unique; points without
    coordinates (NULL, NaN) and vertices without them meet nothing.
    """
    cells, bands = map(durable, covering(shapes, cell))
    bands = bands.withColumnsRenamed({"shape_id": "of shape", "band": "the band", "edges": "edges of the band"})
    cells = cells.select("cell x", "cell y", "code", F.col("shape_id").alias("of shape"), F.col("scale").alias("bands a unit"), F.col("inside").alias("cell inside"))
    placed = points.withColumns({f"cell {c}": F.when(~F.isnan(c), _cell(F.col(c), size)) for c, size in zip("xy", cell, strict=True)})
    band = F.floor(F.col("y") * F.col("bands a unit"))
    odd = F.size(F.filter("edges of the band", lambda e: crosses_right(F.col("x"), F.col("y"), e))) % 2 == 1
    if cells.limit(FEW + 1).count() <= FEW and (bands.agg(F.sum(F.size("edges of the band"))).first()[0] or 0) <= FEW:
        # counted, and few: both are sent to the points, which are read once and stay where they are
        beside = placed.join(F.broadcast(cells), ["cell x", "cell y"]).withColumn("the band", band).join(F.broadcast(bands), ["of shape", "the band"], "left")
        return beside.filter(F.col("cell inside") | F.coalesce(odd, F.lit(False))).select(*points.columns, "code")
    settled = placed.join(cells.filter("`cell inside`"), ["cell x", "cell y"]).select(*points.columns, "code")
    open_ = placed.join(cells.filter("NOT `cell inside`"), ["cell x", "cell y"]).withColumn("the band", band).drop("bands a unit", "cell x", "cell y", "cell inside")
    beside = open_.join(bands, ["of shape", "the band"])
    return settled.unionByName(beside.filter(odd).select(*points.columns, "code"))


def segments(lines: DataFrame, key: str = "id") -> DataFrame:
    """(key, part, i, ax, ay, bx, by, len): the segments of ``parts``, in order."""
    parts = lines.select(key, F.posexplode("parts").alias("part", "points"))
    steps = parts.select(key, "part", "points", F.explode(F.when(F.size("points") > 1, F.sequence(F.lit(1), F.size("points") - 1))).alias("i"))
    ends = steps.select(key, "part", "i", F.element_at("points", F.col("i")).alias("a"), F.element_at("points", F.col("i") + 1).alias("b"))
    return ends.select(key, "part", "i", *[F.col(f"{e}.{c}").alias(e + c) for e in "ab" for c in "xy"]).withColumn("len", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))


def _first_point(lines: DataFrame, key: str) -> DataFrame:
    point = F.try_element_at(F.flatten("parts"), F.lit(1))
    return lines.select(key, point.alias("p")).select(key, F.col("p.x").alias("fx"), F.col("p.y").alias("fy"))


def line_centroid(lines: DataFrame, key: str = "id") -> DataFrame:
    """(key, x, y): length-weighted centroid of each line; its first point if all points coincide; NULL without points."""
    s = segments(lines, key).filter("len > 0")
    sums = s.groupBy(key).agg(F.sum((F.col("ax") + F.col("bx")) / 2 * F.col("len")).alias("sx"), F.sum((F.col("ay") + F.col("by")) / 2 * F.col("len")).alias("sy"), F.sum("len").alias("total"))
    out = _first_point(lines, key).join(sums, key, "left")
    return out.select(key, F.coalesce(F.col("sx") / F.col("total"), F.col("fx")).alias("x"), F.coalesce(F.col("sy") / F.col("total"), F.col("fy")).alias("y"))


def point_on_line(lines: DataFrame, key: str = "id") -> DataFrame:
    """(key, x, y): the point at half of the length, walked over the parts in order; the first point if the length is 0."""
    order = W.partitionBy(key).orderBy("part", "i").rowsBetween(W.unboundedPreceding, 0)
    walked = segments(lines, key).withColumns({"upto": F.sum("len").over(order), "total": F.sum("len").over(W.partitionBy(key))})
    reach = walked.filter((F.col("total") > 0) & (F.col("upto") >= F.col("total") / 2))
    # the first segment that reaches the half: an aggregate, not a second sort
    first = reach.groupBy(key).agg(F.min_by(F.struct("ax", "ay", "bx", "by", "len", "upto", "total"), F.struct("part", "i")).alias("s"))
    t = F.when(F.col("s.len") > 0, (F.col("s.total") / 2 - (F.col("s.upto") - F.col("s.len"))) / F.nullif(F.col("s.len"), F.lit(0.0))).otherwise(0.0)
    out = _first_point(lines, key).join(first, key, "left")
    return out.select(key, *[F.coalesce(F.col(f"s.a{c}") + (F.col(f"s.b{c}") - F.col(f"s.a{c}")) * t, F.col(f"f{c}")).alias(c) for c in "xy"])


def representative_point(lines: DataFrame, placement: DataFrame, key: str = "id") -> DataFrame:
    """(key, x, y, how), six decimals: the placement point that a bridge used (``how``: centroid or point_on_line), the centroid by default."""
    a = line_centroid(lines, key).select(key, F.col("x").alias("cx"), F.col("y").alias("cy"))
    b = point_on_line(lines, key).select(key, F.col("x").alias("lx"), F.col("y").alias("ly"))
    all_ = a.join(b, key).join(placement.select(key, "how"), key, "left").withColumn("how", F.coalesce("how", F.lit("centroid")))
    on_line = F.col("how") == "point_on_line"
    return all_.select(key, *[F.round(F.when(on_line, F.col(f"l{c}")).otherwise(F.col(f"c{c}")), 6).alias(c) for c in "xy"], "how")


def sample_line(lines: DataFrame, spacing: float, key: str = "id") -> DataFrame:
    """(key, x, y): both ends of each segment and points between them, ``spacing`` apart at most (our own rule)."""
    s = segments(lines, key).withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("len") / spacing)).cast("int"))
    t = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n")))).withColumn("t", F.col("k") / F.col("n"))
    return t.select(key, *[(F.col(f"a{c}") + (F.col(f"b{c}") - F.col(f"a{c}")) * F.col("t")).alias(c) for c in "xy"])
