"""Bridge tables: every candidate kept, none invented, nothing dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..durable import durable
from .spatial import containment_join, line_centroid, point_on_line, sample_line

CONTAINS, AMBIGUOUS, UNRESOLVED, OVERLAP = "contains", "ambiguous", "unresolved", "overlap"
SPATIAL, VIA_LINEAGE = "spatial_containment", "_via_lineage"
AUTO, REVIEW = "auto", "review_required"

NOTE_UNRESOLVED = "in no polygon; not assigned to the nearest one"
NOTE_SEVERAL = "in several polygons; all candidates are kept"


def note_split(code: Column, lg_code: Column) -> Column:
    return F.concat(F.lit("code "), code, F.lit(" was split; "), lg_code, F.lit(" is one of its successors"))


def note_unknown(code: Column) -> Column:
    return F.concat(F.lit("code "), code, F.lit(" has no current counterpart"))


def resolve_codes(codes: DataFrame, current: DataFrame, successors: DataFrame) -> DataFrame:
    """(code, lg_code, via_lineage): what each distinct ``code`` stands for now.

    A code in ``current`` (``code``, ``lg_code``) is itself; else each distinct successor in ``successors`` (``code``, ``lg_code``) is a
    candidate, via lineage; else one row with a NULL ``lg_code`` stays.
    """
    wanted = codes.select("code").distinct()
    now = current.select("code", F.col("lg_code").alias("now")).dropDuplicates(["code"])
    later = successors.select("code", F.col("lg_code").alias("later")).distinct()
    joined = wanted.join(now, "code", "left").join(later, "code", "left")
    via = F.col("now").isNull() & F.col("later").isNotNull()
    return joined.select("code", F.coalesce("now", "later").alias("lg_code"), via.alias("via_lineage")).distinct()


def settle(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate accounting of (keys..., code, lg_code, via_lineage): one row for each candidate, ``code`` NULL for none."""
    count = F.when(F.col("code").isNull(), 0).otherwise(F.count("*").over(W.partitionBy(*keys))).cast("long")
    rows = hits.withColumn("candidate_count", count)
    none, unique = F.col("code").isNull(), F.col("candidate_count") == 1
    relation = F.when(none, UNRESOLVED).when(unique, CONTAINS).otherwise(AMBIGUOUS)
    method = F.when(none, F.lit(UNRESOLVED)).when(F.col("via_lineage"), SPATIAL + VIA_LINEAGE).otherwise(SPATIAL)
    known = F.col("lg_code").isNotNull()
    note = (
        F.when(none, NOTE_UNRESOLVED)
        .when(F.col("via_lineage") & known & ~unique, note_split(F.col("code"), F.col("lg_code")))
        .when(~known, note_unknown(F.col("code")))
        .when(~unique, NOTE_SEVERAL)
    )
    return rows.withColumns({
        "relation_type": relation, "match_method": method, "confidence": F.when(none, 0.0).otherwise(1.0),
        "is_unique_match": F.when(unique, 1).otherwise(0).cast("long"),
        "verification_status": F.when(unique & known, AUTO).otherwise(REVIEW), "mismatch_note": note,
    }).withColumnRenamed("code", "boundary_code").drop("via_lineage")


def point_bridge(points: DataFrame, shapes: DataFrame, current: DataFrame, successors: DataFrame, key: str = "id", cell: tuple[float, float] = (0.05, 0.05)) -> DataFrame:
    """One row for each point and candidate; points in no polygon, or without coordinates, keep one unresolved row.

    Polygons of one code count once; a code with several successors counts once for each. Two codes with one successor stay two candidates.
    """
    codes = containment_join(points.select(key, "x", "y"), shapes, cell)
    return settle(_with_candidates(points.drop("x", "y"), codes, shapes, current, successors, key), [key])


#: Entities in a task where they meet their candidates, or so.
ENTITIES = 250_000


def _with_candidates(rows: DataFrame, codes: DataFrame, shapes: DataFrame, current: DataFrame, successors: DataFrame, key: str, *more: str) -> DataFrame:
    """``rows`` with a row for each candidate of the ``codes`` (key, code, ...) found for them; one with NULLs where none was. The codes of an entity meet in one
    set, so that the entities are joined once and each of them is one row on either side."""
    names = resolve_codes(shapes, current, successors).groupBy("code").agg(F.collect_set(F.struct("lg_code", "via_lineage")).alias("means"))
    parts = -(-rows.count() // ENTITIES)
    if parts > rows.sparkSession.sparkContext.defaultParallelism:
        # what a task sorts and joins does not grow with the input, and adaptive execution does not put it together by its size on disk
        rows, codes = rows.repartition(parts, key), codes.repartition(parts, key)
    sets = codes.groupBy(key).agg(F.collect_set(F.struct("code", *more)).alias("found"))
    joined = rows.join(sets, key, "left").withColumn("f", F.explode_outer("found")).select(*rows.columns, "f.*")
    out = joined.join(F.broadcast(names) if _few(shapes) else names, "code", "left").withColumn("m", F.explode_outer("means"))
    return out.select(*rows.columns, "code", *more, "m.lg_code", F.coalesce("m.via_lineage", F.lit(False)).alias("via_lineage"))


def _few(shapes: DataFrame, most: int = 1_000_000) -> bool:
    """Whether the codes of the shapes, a row each, may be broadcast: counted, not guessed."""
    return shapes.select("code").limit(most + 1).count() <= most


def station_bridge(lines: DataFrame, shapes: DataFrame, current: DataFrame, successors: DataFrame, key: str = "id", cell: tuple[float, float] = (0.05, 0.05)) -> DataFrame:
    """Lines placed by their centroid, or by their halfway point where the centroid lies in no polygon; ``placement_point`` tells which."""
    first = line_centroid(lines, key)
    hit = containment_join(first, shapes, cell).select(key, "code").distinct().withColumn("placement_point", F.lit("centroid"))
    rest = lines.join(hit.select(key).distinct(), key, "left_anti")
    second = containment_join(point_on_line(rest, key), shapes, cell).select(key, "code").distinct().withColumn("placement_point", F.lit("point_on_line"))
    return settle(_with_candidates(lines.drop("parts"), hit.unionByName(second), shapes, current, successors, key, "placement_point"), [key])


def line_bridge(lines: DataFrame, shapes: DataFrame, current: DataFrame, successors: DataFrame, spacing: float, key: str = "id", cell: tuple[float, float] = (0.05, 0.05)) -> DataFrame:
    """(key, lg_code, boundary_code, sample_hits, municipality_count, ...): shapes that a line's sample points touch. Overlap is no choice
    between candidates, so known codes are settled and carry no note; a code without a current counterpart goes to review with its note."""
    hits = containment_join(sample_line(lines, spacing, key), shapes, cell).groupBy(key, "code").agg(F.count("*").alias("sample_hits"))
    named = hits.join(resolve_codes(shapes, current, successors), "code")
    counted = named.withColumn("municipality_count", F.count("*").over(W.partitionBy(key)))
    method = F.when(F.col("via_lineage"), "spatial_sampling" + VIA_LINEAGE).otherwise("spatial_sampling")
    known = F.col("lg_code").isNotNull()
    status, note = F.when(known, AUTO).otherwise(REVIEW), F.when(~known, note_unknown(F.col("code")))
    return counted.withColumns({"relation_type": F.lit(OVERLAP), "match_method": method, "verification_status": status, "mismatch_note": note}).withColumnRenamed("code", "boundary_code").drop("via_lineage")


@dataclass(frozen=True)
class By:
    """A matching rule as an equi-join: ``on`` has a column over the entities for each column of ``targets`` that it must equal; ``targets`` has these and ``target``. NULLs agree with nothing."""

    on: dict[str, Column]
    targets: DataFrame


#: Candidates in an array at most, or so.
BLOCK = 1000


def in_blocks(rows: DataFrame, on: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Groups of ``rows`` by ``on``: (on..., n, blocks), and (on..., block, values), the distinct values of a group in arrays of ``BLOCK`` or so. NULLs are not counted, but kept."""
    rows = rows.select(*on, value).distinct()
    sizes = rows.groupBy(*on).agg(F.count(value).alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(sizes.hint("merge"), on).withColumn("block", F.pmod(F.xxhash64(value), F.col("blocks")).cast("int"))
    return sizes, dealt.groupBy(*on, "block").agg(F.collect_list(value).alias("values"))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """Keys of several rows, and NULL."""
    return rows.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).select(key)


def cascade(entities: DataFrame, rules: list[tuple], key: str = "id") -> DataFrame:
    """Ordered matching rules: ``(rule id, confidence, rule[, complete])``, a rule being ``By`` or a function(entities) -> (key, target). An entity keeps the matches of the first rule that
    matches it; what no rule matches stays, unresolved. Candidates are counted by entity and nothing is chosen among them. ``complete`` (True by
    default) tells whether a rule's evidence names all candidates; it becomes ``candidate_count_is_complete``.

    An entity meets the number of each rule's candidates first, keeps a rule, and only then its candidates, in arrays by what they agree in: pairs are made last, and not shuffled.
    """
    twice = repeated(entities, key)
    if not twice.isEmpty():  # the candidates of an entity with several rows are those of all its rows
        twice = twice.select(F.col(key).alias("the key"))
        same = F.col(key).eqNullSafe(F.col("the key"))
        return _by_numbers(entities.join(twice, same, "left_anti"), rules, key).unionByName(_by_pairs(entities.join(twice, same, "left_semi"), rules, key))
    return _by_numbers(entities, rules, key)


def _by_numbers(entities: DataFrame, rules: list[tuple], key: str) -> DataFrame:
    """``cascade`` of entities with one row each."""
    rules = [(rule, confidence, match if isinstance(match, By) else By({key: F.col(key)}, match(entities).select(key, "target")), not complete or complete[0]) for rule, confidence, match, *complete in rules]
    met = entities.select(key, *[c.alias(f"{name} {i}") for i, (_, _, by, _) in enumerate(rules) for name, c in by.on.items()])
    arrays = []
    for i, (_, _, by, _) in enumerate(rules):
        on = [f"{name} {i}" for name in by.on]
        rows = by.targets.select(*[F.col(name).alias(c) for name, c in zip(by.on, on, strict=True)], F.col("target").cast("string").alias("target"))
        rows = rows.filter(F.forall(F.array(*[F.col(c).isNotNull() for c in rows.columns]), lambda known: known))
        sizes, values = in_blocks(rows, on, "target")
        met = met.join(sizes.withColumnsRenamed({"n": f"n {i}", "blocks": f"blocks {i}"}).hint("merge"), on, "left")
        arrays.append((on, values))
    group = F.concat(F.lit("grp_"), F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 16))
    first = F.coalesce(*[F.when(F.col(f"n {i}").isNotNull(), i) for i in range(len(rules))], F.lit(-1))
    met = durable(met.withColumns({"rule": first, "group": group}))
    out = None
    for i, (rule, confidence, complete) in enumerate([*[(r, c, w) for r, c, _, w in rules], (UNRESOLVED, 0.0, True)]):
        if i < len(rules):
            on, values = arrays[i]
            asked = met.filter(F.col("rule") == i).select(key, "group", *on, F.col(f"n {i}").alias("n"), F.explode(F.sequence(F.lit(0), F.col(f"blocks {i}") - 1)).alias("block"))
            # dealt by group and block, so that a group with many entities and many candidates is spread
            rows = asked.join(values.hint("merge"), [*on, "block"]).select(asked[key], "group", "n", F.explode("values").alias("target"))
        else:
            rows = met.filter("rule = -1").select(key, "group", F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("target"))
        rows = rows.select(
            key, "target", F.lit(rule).alias("matching_rule_id"), F.lit(float(confidence)).alias("confidence"), F.lit(complete).alias("candidate_count_is_complete"),
            F.col("group").alias("candidate_group_id"), F.col("n").alias("candidate_count"), *_relations(F.col("n")),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _by_pairs(entities: DataFrame, rules: list[tuple], key: str) -> DataFrame:
    """``cascade`` of entities with any number of rows: all pairs of each rule, the least rule kept by an aggregate."""
    found = None
    for n, (rule, confidence, match, *complete) in enumerate(rules):
        marks = {"order": F.lit(n), "matching_rule_id": F.lit(rule), "confidence": F.lit(float(confidence)), "candidate_count_is_complete": F.lit(complete[0] if complete else True)}
        if isinstance(match, By):
            on = [f"{name} {n}" for name in match.on]
            targets = match.targets.select(*[F.col(name).alias(c) for name, c in zip(match.on, on, strict=True)], "target")
            rows = entities.select(F.col(key).alias("the key"), *[c.alias(a) for c, a in zip(match.on.values(), on, strict=True)]).join(targets, on).withColumnRenamed("the key", key)
        else:
            rows = match(entities)
        rows = rows.select(key, F.col("target").cast("string").alias("target")).filter("target IS NOT NULL").distinct().withColumns(marks)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        none = {"target": F.lit(None).cast("string"), "matching_rule_id": F.lit("unresolved"), "confidence": F.lit(0.0), "candidate_count_is_complete": F.lit(True)}
        return candidate_accounting(entities.select(key).distinct().withColumns(none), key, "target")
    first = found.groupBy(key).agg(F.min("order").alias("order"))
    kept = entities.select(key).distinct().join(found.join(first, [key, "order"]).drop("order"), key, "left")
    kept = kept.withColumns({"matching_rule_id": F.coalesce("matching_rule_id", F.lit("unresolved")), "confidence": F.coalesce("confidence", F.lit(0.0)), "candidate_count_is_complete": F.coalesce("candidate_count_is_complete", F.lit(True))})
    return candidate_accounting(kept, key, "target")


def _relations(count: Column) -> list[Column]:
    unique = count == 1
    return [unique.alias("is_unique_match"), F.when(count == 0, UNRESOLVED).when(unique, "exact").otherwise(AMBIGUOUS).alias("relation_type"), F.when(unique, AUTO).otherwise(REVIEW).alias("verification_status")]


def candidate_accounting(rows: DataFrame, key: str, target: str) -> DataFrame:
    """``candidate_group_id``, ``candidate_count``, ``is_unique_match``, ``relation_type``, ``verification_status``."""
    count = F.count(target).over(W.partitionBy(key))
    unique = F.col("candidate_count") == 1
    return rows.withColumns({"candidate_group_id": F.concat(F.lit("grp_"), F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 16)), "candidate_count": count}).withColumns({
        "is_unique_match": unique,
        "relation_type": F.when(F.col("candidate_count") == 0, UNRESOLVED).when(unique, "exact").otherwise(AMBIGUOUS),
        "verification_status": F.when(unique, AUTO).otherwise(REVIEW),
    })


def reconcile(left: DataFrame, right: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """(code, in_left, in_right, status) of boundary codes (left) and current codes (right), both by ``code``.

    ``facts``: ``parents`` (code), ``retired`` (old, new), ``blank`` (code), ``unsurveyed`` (code). A status that explains
    the difference is found for each one-sided code, else it is ``left_only`` or ``right_only``: unexplained.
    """
    both = left.select("code").distinct().withColumn("in_left", F.lit(True)).join(right.select("code").distinct().withColumn("in_right", F.lit(True)), "code", "full_outer")
    flags = {"parent": facts["parents"].select("code"), "blank": facts["blank"].select("code"), "unsurveyed": facts["unsurveyed"].select("code"), "successor": facts["retired"].select(F.col("new").alias("code"))}
    for name, df in flags.items():
        both = both.join(df.distinct().withColumn(name, F.lit(True)), "code", "left")
    splits = facts["retired"].groupBy(F.col("old").alias("code")).agg(F.countDistinct("new").alias("successors"))
    both = both.join(splits, "code", "left")
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = (
        F.when(on("in_left") & on("in_right"), "matched")
        .when(on("in_right") & on("parent"), "designated_city_parent")
        .when(on("in_right") & on("successor"), "successor")
        .when(on("in_right") & on("unsurveyed"), "not_surveyed")
        .when(on("in_right"), "right_only")
        .when(on("blank"), "unassigned_area")
        .when(F.col("successors") == 1, "superseded")
        .when(F.col("successors") > 1, "split_no_single_successor")
        .otherwise("left_only")
    )
    return both.select("code", on("in_left").alias("in_left"), on("in_right").alias("in_right"), status.alias("status"))


def station_lines(features: DataFrame) -> DataFrame:
    """(station, line, operator, n_features, name_variants, name): which lines a station is on, from its features (station, line, operator, name). A station has a
    row for each line and operator; the least name is told, and how many there are."""
    return features.groupBy("station", "line", "operator").agg(F.count("*").alias("n_features"), F.countDistinct("name").alias("name_variants"), F.min("name").alias("name"))
