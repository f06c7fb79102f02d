"""Mixing sources to target weights by temperature.

Source weights are token shares to the power ``a``, normalised: 1 keeps the natural shares, 0 gives all sources the same.
The exponent is bisected to the largest one that still reaches a target entropy, or the smallest one that keeps every source's
repetition under a limit. The weights are then realised: each source's budget of tokens is spent on whole passes over its
documents and one partial pass, in an order made of permuted blocks of documents in permuted order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import durable, named, rest

#: Sources whose totals the driver takes; of more, the exponent is searched by aggregations, and nothing is collected.
COLLECTED = 100_000
#: Exponents that one such aggregation tries, and aggregations.
GRID, PASSES = 32, 8


def tempered(tokens: dict, exponent: float) -> dict:
    """Normalised powers of the token shares; sources without tokens have weight 0."""
    total = sum(tokens.values())
    raw = {s: (t / total) ** exponent if t else 0.0 for s, t in sorted(tokens.items(), key=repr)}
    scale = sum(raw.values())
    return {s: x / scale if scale else 0.0 for s, x in raw.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def passes_needed(tokens: dict, weights: dict) -> float:
    """The least budget, in tokens, that gives each source one whole pass at least."""
    return max((tokens[s] / w for s, w in weights.items() if w > 0), default=0.0)


def repetition(tokens: dict, weights: dict, budget: float | None) -> float:
    """Passes over the source that is repeated most."""
    spent = passes_needed(tokens, weights) if budget is None else budget
    return max((w * spent / tokens[s] for s, w in weights.items() if tokens[s]), default=0.0)


def bisect_exponent(tokens: dict, target_entropy: float | None = None, max_repetition: float | None = None, budget: float | None = None, steps: int = 60) -> float:
    """``target_entropy`` is a share of the highest possible (0 to 1). Entropy falls and repetition falls as the exponent
    grows from 0 to 1; the repetition limit wins where both are given and clash. Out of reach: the nearer end."""

    def search(holds, low, high):  # holds(low) is wanted true, holds(high) false
        if holds(high):
            return high
        if not holds(low):
            return low
        for _ in range(steps):
            middle = (low + high) / 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low

    sources = sum(t > 0 for t in tokens.values())
    exponent = 1.0
    if target_entropy is not None and sources > 1:
        exponent = search(lambda a: entropy(tempered(tokens, a)) >= target_entropy * math.log(sources), 0.0, 1.0)
    elif max_repetition is not None:
        exponent = 0.0
    if max_repetition is not None:
        exponent = max(exponent, search(lambda a: repetition(tokens, tempered(tokens, a), budget) <= max_repetition, 1.0, 0.0))
    return exponent


def toward_even_target(entropy_now: float, sources: int, gap_closed: float) -> float:
    """The target, as a share of the highest entropy, that closes ``gap_closed`` (0 to 1) of the gap from ``entropy_now`` to it."""
    highest = math.log(sources) if sources > 1 else 1.0
    return (entropy_now + gap_closed * (highest - entropy_now)) / highest


def words_of(text) -> Column:
    """The number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _collected_plan(rows: list, weights: dict, spent: float, block: int) -> list:
    """(source, weight, whole passes, tokens of the last one, blocks) of each source."""
    plan = []
    for s, t, n in rows:
        due = weights[s] * spent
        whole = int(due / t + 1e-9) if t else 1
        plan.append((s, float(weights[s]), whole, max(0.0, due - whole * t) if t and due / t - whole > 1e-9 else 0.0, -(-n // block)))
    return plan


def _aggregated_plan(by_source: DataFrame, target_entropy, gap_closed, max_repetition, budget, block: int) -> DataFrame:
    """The same for any number of sources: sums of powers of the shares are aggregated for a grid of exponents, then for a finer one."""
    total, least, most, sources = by_source.filter("t > 0").agg(F.sum("t"), F.min("t"), F.max("t"), F.count("*")).first()
    spark = by_source.sparkSession
    share = F.col("t") / F.lit(float(total or 1))

    def sums(exponents):
        """exponent -> (sum of the powers, sum of the powers times the logarithm of the share)."""
        grid = by_source.filter("t > 0").select(share.alias("p"), F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a"))
        power = F.pow("p", F.col("a"))
        found = grid.groupBy("a").agg(F.sum(power).alias("x"), F.sum(power * F.log("p")).alias("y")).collect()
        return {r.a: (r.x, r.y) for r in found}

    def entropy_at(a, x, y):
        return math.log(x) - a * y / x

    def largest(holds):
        """The largest exponent from 0 to 1 of those that hold, which are the smaller ones; 0 if none does."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            exponents = sorted({low + (high - low) * i / GRID for i in range(GRID + 1)})
            found = sums(exponents)
            good = [a for a in exponents if holds(a, *found[a])]
            if not good or good[-1] == exponents[-1]:
                return good[-1] if good else low
            low, high = good[-1], exponents[exponents.index(good[-1]) + 1]
        return low

    exponent = 1.0
    if sources and sources > 1:
        if gap_closed is not None:
            target_entropy = toward_even_target(entropy_at(1.0, *sums([1.0])[1.0]), sources, gap_closed)
        if target_entropy is not None:
            exponent = largest(lambda a, x, y: entropy_at(a, x, y) >= target_entropy * math.log(sources))
        elif max_repetition is not None:
            exponent = 0.0
        if max_repetition is not None:  # the rarest source is repeated most
            if budget is None:
                lowest = 1 - math.log(max_repetition) / math.log(most / least) if most > least and most / least > max_repetition else 0.0
            else:
                over = lambda a, x, y: budget / total * (least / total) ** (a - 1) / x > max_repetition
                lowest = largest(over)
            exponent = max(exponent, lowest)
    scale = sums([exponent])[exponent][0] if sources else 1.0
    spent = budget if budget is not None else (total or 0) * scale * (most / total) ** (1 - exponent) if sources else 0.0
    weight = F.when(F.col("t") > 0, F.pow(share, F.lit(exponent)) / scale).otherwise(0.0)
    due = F.col("weight") * F.lit(float(spent))
    times = due / F.nullif(F.col("t"), F.lit(0))
    plan = by_source.select(F.col("s").alias("ps"), "t", "n", weight.alias("weight")).withColumn("whole", F.coalesce(F.floor(times + 1e-9), F.lit(1)).cast("int"))
    left = F.when((F.col("t") > 0) & (times - F.col("whole") > 1e-9), F.greatest(F.lit(0.0), due - F.col("whole") * F.col("t"))).otherwise(0.0)
    return durable(plan.select("ps", "weight", "whole", left.alias("left"), F.ceil(F.col("n") / block).cast("long").alias("blocks")))


def mix_sources(docs: DataFrame, target_entropy: float | None = 0.95, max_repetition: float | None = 2.0, budget: float | None = None, seed: int = 0, block: int = 1000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens_col: str | None = None, gap_closed: float | None = None, collected: int = COLLECTED) -> DataFrame:
    """The mixed corpus: columns of ``docs``, then ``mix_epoch``, ``mix_block`` and ``mix_order``; a row for each use of a document.

    ``tokens_col`` holds a document's tokens (null: none); without it, tokens are the words of the whole text. The target is
    ``target_entropy``, a share of the highest entropy, or, with ``gap_closed``, the one that closes this share of the gap between the
    natural shares' entropy and the highest. ``budget`` is the corpus's size in tokens; None takes the least that uses every document
    once at least. A source's budget buys whole passes (epochs 0, 1, ...) over all of its documents, then the first documents of a
    last pass: those that begin before the budget is spent. In each pass the blocks of about ``block``
    documents come in an order of their own, and so do the documents of a block; ordered by ``mix_epoch``, ``mix_block``, ``mix_order``
    and the id, the rows of a source are that order. A null source is a source; a document without tokens costs nothing and is used in every
    pass that reaches it; a source without any tokens is used once. Null ids and repeated rows are documents like others (rows of one id and one
    text share a place in the order). An empty table gives an empty result. Columns named like the added ones, in any case, are replaced.
    The uses of a document follow each other.

    Totals by source go to the driver if there are ``collected`` sources at most; else the exponent is searched by aggregations, to a
    fortieth binary place, and the sources' plan is joined instead of broadcast: weights agree but for rounding. Totals of blocks,
    not of documents, are summed up in order, by source; documents are summed up only in the one block where a budget ends.
    """
    added = ["mix_epoch", "mix_block", "mix_order"]
    kept = rest(docs, *added)
    spark = docs.sparkSession
    tokens_of = F.coalesce(named(tokens_col).cast("long"), F.lit(0).cast("long")) if tokens_col else words_of(named(text_col))
    slim = docs.select(named(id_col).cast("long").alias("id"), F.xxhash64(named(text_col)).alias("own"), named(source_col).cast("string").alias("s"), tokens_of.alias("t"))
    if not tokens_col:
        slim = durable(slim)  # texts are counted once
    by_source = slim.groupBy("s").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    rows = [tuple(r) for r in by_source.limit(collected + 1).collect()]
    few = len(rows) <= collected
    if few:
        tokens = {s: t for s, t, _ in rows}
        if gap_closed is not None:
            target_entropy = toward_even_target(entropy(tempered(tokens, 1.0)), sum(t > 0 for t in tokens.values()), gap_closed)
        weights = tempered(tokens, bisect_exponent(tokens, target_entropy, max_repetition, budget))
        spent = passes_needed(tokens, weights) if budget is None else budget
        plan = spark.createDataFrame(_collected_plan(rows, weights, spent, block), "ps string, weight double, whole int, left double, blocks long")
    else:
        plan = _aggregated_plan(durable(by_source), target_entropy, gap_closed, max_repetition, budget, block)

    def by_sources(df):
        """A table of a row for each source, for a join: broadcast if the sources are few, else in a way that lets hot ones be split."""
        return F.broadcast(df) if few else df.hint("merge")

    plan = by_sources(plan)

    def place(df, id_, own, epoch):
        """Block of a document (the same in all passes), and the order of blocks and of documents in a pass."""
        b = F.pmod(F.xxhash64(F.lit(seed), id_, own), F.col("blocks"))
        return df.withColumn("mix_block", F.xxhash64(F.lit(seed), epoch, F.col("s"), b)).withColumn("mix_order", F.xxhash64(F.lit(seed), epoch, id_, own))

    # The last, partial pass: which block does each source's budget end in, and how much is left there?
    partial = place(slim.join(plan, F.col("s").eqNullSafe(F.col("ps"))).filter("left > 0"), F.col("id"), F.col("own"), F.col("whole"))
    blocks = partial.groupBy("s", "mix_block").agg(F.sum("t").alias("bt"), F.first("left").alias("left"))
    blocks = durable(blocks.withColumn("span", F.shiftright("mix_block", 48)))

    def crossing(df, order):
        """The row of each source in which its budget ends, with the budget left before it."""
        running = df.withColumn("before", F.sum("bt").over(W.partitionBy("s").orderBy(order)) - F.col("bt"))
        return running.filter("before < left AND before + bt >= left").withColumn("room", F.col("left") - F.col("before"))

    # 65,536 spans of blocks a source at most, then the blocks of one span: no window holds all blocks of a source.
    spans = crossing(blocks.groupBy("s", "span").agg(F.sum("bt").alias("bt"), F.first("left").alias("left")), "span")
    spans = by_sources(spans.select(F.col("s").alias("es"), F.col("span").alias("at"), "room"))  # one span a source
    inner = blocks.join(spans, F.col("s").eqNullSafe(F.col("es")) & (F.col("span") == F.col("at"))).withColumn("left", F.col("room"))
    edge = durable(crossing(inner.select("s", "mix_block", "bt", "left"), "mix_block").select("s", F.col("mix_block").alias("edge"), "room"))  # one block a source
    at_edge = partial.join(by_sources(edge.withColumnRenamed("s", "es")), F.col("s").eqNullSafe(F.col("es")) & (F.col("mix_block") == F.col("edge")))
    inside = at_edge.withColumn("before", F.sum("t").over(W.partitionBy("s").orderBy("mix_order", "id")) - F.col("t"))
    last = inside.filter("before < room").groupBy(F.col("s").alias("ls")).agg(F.max("edge").alias("edge"), F.max(F.struct("mix_order", "id")).alias("last"))

    carried = F.struct(F.lit(0).alias("_"), *[named(c).alias(f"c{i}") for i, c in enumerate(kept)]).alias("carried")
    full = docs.select(carried, named(id_col).cast("long").alias("id"), F.xxhash64(named(text_col)).alias("own"), named(source_col).cast("string").alias("s"))
    full = full.join(plan, F.col("s").eqNullSafe(F.col("ps"))).join(by_sources(last), F.col("s").eqNullSafe(F.col("ls")), "left")
    full = full.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    full = place(full, F.col("id"), F.col("own"), F.col("mix_epoch"))
    taken = (F.col("mix_epoch") < F.col("whole")) | (F.col("mix_block") < F.col("edge")) | ((F.col("mix_block") == F.col("edge")) & (F.struct("mix_order", "id") <= F.col("last")))
    return full.filter(taken).select(*[F.col(f"carried.c{i}").alias(c) for i, c in enumerate(kept)], *added)


def op10_mixing(spark, sf_dir):
    """The mixed corpus by ids: a row for each use of a document, with its words and its place. The target closes half of the gap between the natural
    entropy and the highest, so the exponent is below 1 wherever sources differ in size."""
    from ._common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_of(F.col("text")).alias("n_words"), F.xxhash64("text").alias("own"))
    mixed = mix_sources(durable(docs), text_col="own", tokens_col="n_words", gap_closed=0.5)  # texts are read once
    return mixed.select("doc_id", "source", "n_words", "mix_epoch", "mix_block", "mix_order")
