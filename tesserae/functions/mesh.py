"""Standard grid square codes (JIS X 0410) as arithmetic on columns, and lookups in runs of codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..durable import durable
from ..operators.spatial import ring_edges, touched_cells


def _pair(lat: Column, lng: Column, per_lat: int, per_lng: int) -> tuple[Column, Column]:
    return F.floor(lat * per_lat).cast("long"), F.floor(lng * per_lng).cast("long")


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("long")


def third_code(row: Column, col: Column) -> Column:
    """8 digits as a number, from the row (1/120 degree) and the column (1/80 degree)."""
    first = _div(row, 80) * 1_000_000 + (_div(col, 80) - 100) * 10_000
    return first + _div(row % 80, 10) * 1000 + _div(col % 80, 10) * 100 + row % 10 * 10 + col % 10


def mesh3(lat: Column, lng: Column) -> Column:
    return third_code(*_pair(lat, lng, 120, 80))


def mesh6(lat: Column, lng: Column) -> Column:
    """11 digits as a string: three halvings of the third-order square, each numbered 1 (south-west) to 4 (north-east)."""
    row, col = _pair(lat, lng, 960, 640)
    digits = [(1 + _div(col, b) % 2 + 2 * (_div(row, b) % 2)).cast("string") for b in (4, 2, 1)]
    return F.concat(F.lpad(third_code(_div(row, 8), _div(col, 8)).cast("string"), 8, "0"), *digits)


def mesh2(lat: Column, lng: Column) -> Column:
    """6 digits as a string: 1/12 degree by 1/8 degree."""
    row, col = _pair(lat, lng, 12, 8)
    return F.concat(F.lpad(_div(row, 8).cast("string"), 2, "0"), F.lpad((_div(col, 8) - 100).cast("string"), 2, "0"), (row % 8).cast("string"), (col % 8).cast("string"))


def parse_mesh(code: Column) -> Column:
    """struct(row, col, span, level) in sixth-order squares, of a code of 8 to 11 digits; NULL if it is not valid."""
    valid = F.coalesce(code.rlike(r"^\d{4}[0-7]{2}\d{2}[1-4]{0,3}$"), F.lit(False))
    digit = lambda i, n=1: F.substring(code, i, n).cast("long")
    row = (digit(1, 2) * 80 + digit(5) * 10 + digit(7)) * 8
    col = ((digit(3, 2) + 100) * 80 + digit(6) * 10 + digit(8)) * 8
    for i, span in ((9, 4), (10, 2), (11, 1)):
        d = F.when(F.length(code) >= i, F.try_to_number(F.substring(code, i, 1), F.lit("9")).cast("long") - 1).otherwise(0)
        row, col = row + _div(d, 2) * span, col + d % 2 * span
    level = (F.length(code) - 5).cast("int")
    return F.when(valid, F.struct(row.alias("row"), col.alias("col"), F.pow(F.lit(2), 11 - F.length(code)).cast("int").alias("span"), level.alias("level")))


def meshes_in(south: float, west: float, north: float, east: float, spark) -> DataFrame:
    """(mesh): second-order squares that a viewport touches."""
    view = spark.createDataFrame([(south, west, north, east)], "s double, w double, n double, e double")
    rows = view.select("w", "e", F.explode(F.sequence(F.floor(F.col("s") * 12), F.floor(F.col("n") * 12))).alias("r"))
    cells = rows.select("r", F.explode(F.sequence(F.floor(F.col("w") * 8), F.floor(F.col("e") * 8))).alias("c"))
    return cells.select(mesh2((F.col("r") + 0.5) / 12, (F.col("c") + 0.5) / 8).alias("mesh")).distinct()


def square_number(row: Column, col: Column, level: int) -> Column:
    """A square's place in the order of codes, as a number: at third order the code itself; below, each halving counts four squares for one, south-west first. Squares of
    one larger square, up to the second order, have consecutive numbers."""
    span = 2 ** (level - 3)
    number = third_code(_div(row, span), _div(col, span)) * 4 ** (level - 3)
    for k in range(level - 3):
        number = number + (_div(col, 2**k) % 2 + 2 * (_div(row, 2**k) % 2)) * 4**k
    return number


def build_runs(shapes: DataFrame, level: int = 6) -> DataFrame:
    """(start, len, ids, uniform): runs of consecutive squares of order ``level`` (3 to 6) that the same ``shapes`` (id, rings of longitude x and latitude y) reach.

    ``uniform``: wholly inside one shape, and in no other; else the run is mixed, with every shape that reaches its squares, alone or not. Squares that none reaches are
    in no run. Numbers are those of ``square_number``; runs are as long as can be, and disjoint. Ids are unique; shapes without three vertices reach nothing.

    A quadtree from the second order down: a square that no edge touches is settled whole, the others are cut. Which side of the border a settled square lies on is the parity of
    the edges that cross a line through its row, further east: a running sum over the squares of a row, border squares and cut ones only. So the work grows with the length of
    borders, but for second-order squares inside. Intervals of numbers then meet by the squares that hold them, not by ranges.
    """
    span = 2 ** (level - 3)
    scaled = lambda p: F.struct((p["x"] * F.lit(80 * span)).alias("x"), (p["y"] * F.lit(120 * span)).alias("y"))
    rings = F.transform("rings", lambda r: F.transform(r, scaled))
    edges = shapes.select("id", F.explode(ring_edges(rings)).alias("e")).select("id", "e.*")
    fine = durable(touched_cells(edges, (1.0, 1.0), "id").withColumnsRenamed({"cell y": "row", "cell x": "col"}))
    levels = [(2, 10 * span), *[(k, 2 ** (level - k)) for k in range(3, level + 1)]]
    size_of = {k: 4 ** (level - k) if k > 2 else 100 * 4 ** (level - 3) for k, _ in levels}
    row = W.partitionBy("id", "row").orderBy(F.col("col").desc())
    odd = F.coalesce(F.sum("crossings").over(row.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2 == 1
    found, before = [], None
    for k, m in levels:
        line = F.when(F.col("row") % m == 0, F.col("crossings")).otherwise(0)  # the row's southernmost fine row stands for it
        border = fine.withColumn("crossings", line).groupBy("id", _div(F.col("row"), m).alias("row"), _div(F.col("col"), m).alias("col")).agg(F.sum("crossings").alias("crossings"))
        if before is None:
            gaps = border.withColumns({"odd": odd, "next": F.lag("col").over(row)}).filter("odd AND next > col + 1")
            inside = gaps.select("id", "row", F.explode(F.sequence(F.col("col") + 1, F.col("next") - 1)).alias("col"))
        else:
            parts = range(before[1] // m)
            offsets = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in parts for c in parts])
            cut = before[0].select("id", "row", "col", F.explode(offsets).alias("o")).select("id", *[(F.col(a) * len(parts) + F.col(f"o.{a[0]}")).alias(a) for a in ("row", "col")])
            both = border.withColumn("touched", F.lit(1)).unionByName(cut.withColumns({"crossings": F.lit(0).cast("long"), "touched": F.lit(0)}))
            both = both.groupBy("id", "row", "col").agg(F.sum("crossings").alias("crossings"), F.max("touched").alias("touched"))
            inside = both.withColumn("odd", odd).filter("odd AND touched = 0").select("id", "row", "col")
        found.append(inside.select("id", F.lit(k).alias("level"), square_number(F.col("row") * m, F.col("col") * m, level).alias("start"), F.lit(True).alias("inside")))
        before = border, m
    found.append(fine.select("id", F.lit(level).alias("level"), square_number(F.col("row"), F.col("col"), level).alias("start"), F.lit(False).alias("inside")))
    return _joined_runs(durable(reduce(DataFrame.unionByName, found)), size_of)


def _joined_runs(squares: DataFrame, size_of: dict[int, int]) -> DataFrame:
    """Runs of the squares (id, level, start, inside), of ``size_of`` numbers by level, each aligned to its size."""
    block = size_of[2]
    sizes = F.create_map(*[F.lit(x) for k, n in size_of.items() for x in (k, n)])
    squares = squares.withColumn("len", F.element_at(sizes, F.col("level")).cast("long"))
    ends = squares.select(_div(F.col("start"), block).alias("block"), F.explode(F.array("start", F.col("start") + F.col("len"))).alias("p"))
    cuts = ends.filter(F.col("p") < (F.col("block") + 1) * block).distinct()
    pieces = cuts.withColumn("q", F.coalesce(F.lead("p").over(W.partitionBy("block").orderBy("p")), (F.col("block") + 1) * block))
    holders = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), _div(F.col("p"), n).alias("square")) for k, n in size_of.items()]))
    # squares are many for each shape, whatever the size of the shapes' files lets a planner expect: never broadcast
    held = pieces.withColumn("h", holders).select("block", "p", "q", "h.*").join(squares.withColumn("square", F.floor(F.col("start") / F.col("len"))).hint("merge"), ["level", "square"])
    runs = held.groupBy("block", "p", "q").agg(F.sort_array(F.collect_set("id")).alias("ids"), F.min("inside").alias("inside"))
    runs = runs.select("block", "p", "q", "ids", (F.col("inside") & (F.size("ids") == 1)).alias("uniform"))
    for group in (["block"], ["ids", "uniform"]):  # within blocks, then what is left at their borders
        order = W.partitionBy(*group).orderBy("p")
        goes_on = (F.lag("q").over(order) == F.col("p")) & (F.lag("ids").over(order) == F.col("ids")) & (F.lag("uniform").over(order) == F.col("uniform"))
        runs = runs.withColumn("begins", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("begins").over(order))
        runs = runs.groupBy(*dict.fromkeys([*group, "run", "ids", "uniform"])).agg(F.min("p").alias("p"), F.max("q").alias("q"))
    return runs.select(F.col("p").alias("start"), (F.col("q") - F.col("p")).alias("len"), "ids", "uniform")


def run_lookup(codes: DataFrame, runs: DataFrame, width: int | None = None) -> DataFrame:
    """(code, ids, kind) for ``codes`` (code) in ``runs`` (start, len, ids): which run holds the code. Runs are disjoint; two that overlap are an error.

    One id: contains; several: ambiguous; the unknown id (65535) alone: unknown; no run: none. A sweep: starts and codes stand in one order, dealt out by ranges; within a part the
    last run that has begun is carried on, and each part takes over from the parts before it the one run that may still be open. A run of any length is one row;
    ``width`` is accepted from earlier callers and has no meaning.
    """
    run = F.struct("start", "len", "ids")
    nothing = F.lit(None).cast(runs.select(run.alias("r")).schema["r"].dataType)
    stands = runs.select(F.col("start").cast("long").alias("at"), F.lit(0).alias("kind"), run.alias("run"))
    asked = codes.select(F.col("code").cast("long").alias("at")).filter("at IS NOT NULL").distinct().select("at", F.lit(1).alias("kind"), nothing.alias("run"))
    placed = durable(stands.unionByName(asked).repartitionByRange("at").sortWithinPartitions("at", "kind").withColumn("part", F.spark_partition_id()))
    last = placed.groupBy("part").agg(F.max_by("run", F.when(F.col("kind") == 0, F.col("at"))).alias("last"))
    carried = last.select("part", F.last("last", ignorenulls=True).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))  # a row a part
    order = W.partitionBy("part").orderBy("at", "kind")
    own = F.last("run", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    swept = placed.withColumns({"own": own, "before": F.last("run", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))}).join(F.broadcast(carried), "part", "left")
    before = F.coalesce("before", "carried")
    overlap = (F.col("kind") == 0) & (before["start"] + before["len"] > F.col("at"))
    stop = F.raise_error(F.concat(F.lit("[VALIDATION_FAILED] runs overlap at "), F.col("at").cast("string")))
    swept = swept.filter(F.when(overlap, stop.cast("boolean")).otherwise(F.col("kind") == 1)).withColumn("run", F.coalesce("own", "carried"))
    hit = swept.filter("at < run.start + run.len").select(F.col("at").alias("code"), "run.ids")
    kind = F.when(F.col("ids").isNull(), "none").when(F.size("ids") > 1, "ambiguous").when(F.element_at("ids", 1) == 65535, "unknown").otherwise("contains")
    return codes.join(hit.hint("merge"), "code", "left").withColumn("kind", kind)  # hits carry their ids: never broadcast


def cells_of(runs: DataFrame) -> DataFrame:
    """(id, code): every square that an id reaches, alone or shared."""
    cells = runs.select("ids", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("code"))
    return cells.select(F.explode("ids").alias("id"), "code")


def chunk_origin(key: Column) -> tuple[Column, Column]:
    """(lng, lat) of a chunk's south-west corner: a first- or second-order code, or ``all``."""
    digit = lambda i, n=1: F.try_to_number(F.substring(key, i, n), F.lit("9" * n)).cast("double")
    fine = F.length(key) == 6
    lng = digit(3, 2) + 100 + F.when(fine, digit(6) / 8).otherwise(0.0)
    lat = digit(1, 2) / 1.5 + F.when(fine, digit(5) / 12).otherwise(0.0)
    return F.when(key == "all", 122.0).otherwise(lng), F.when(key == "all", 20.0).otherwise(lat)
