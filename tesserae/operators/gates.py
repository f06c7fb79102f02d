"""Human decisions, staleness, quality gates, release diffs, invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import durable, forget
from ..errors import BuildError, stop_if_any


def all_equal(where: dict) -> Column:
    """Conjunction of equalities; NULL in the data never equals."""
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in where.items()], F.lit(True))


def validate_overrides(overrides: list[dict], bridges: set[str]) -> None:
    """Collect every problem, then stop once."""
    problems, seen = [], set()
    for o in overrides:
        name = o.get("id")
        problems += [f"{name}: {k} is missing" for k in ("id", "table", "where", "set", "decided_by") if not o.get(k)]
        if name in seen:
            problems.append(f"{name}: given twice")
        seen.add(name)
        if o.get("table") and o["table"] not in bridges:
            problems.append(f"{name}: no table {o['table']}")
    if problems:
        raise BuildError("VALIDATION_FAILED", "overrides are not valid", problems=problems)


def is_stale(override: dict, shas: dict[str, str]) -> bool:
    """No recorded source state, or one that differs from today's."""
    recorded = override.get("source_state") or {}
    return not recorded or any(shas.get(k) != v for k, v in recorded.items())


DECISIONS = "`order` long, id string, stale boolean, `where` map<string,string>, `set` map<string,string>"


def decision_rows(spark, overrides: list[dict], shas: dict[str, str]) -> DataFrame:
    """Overrides as a table of decisions (order, id, stale, where, set), values as text."""
    text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    texts = lambda m: {k: text(v) for k, v in m.items()}
    return spark.createDataFrame([(i, o["id"], is_stale(o, shas), texts(o["where"]), texts(o["set"])) for i, o in enumerate(overrides)], DECISIONS)


def apply_decisions(table: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A bridge after ``decisions`` (order, id, stale, where, set), one after the other as ordered, and what each of them did: (id, stale, unknown_columns, rows).

    A fresh decision sets its columns and ``matching_rule_id`` in the rows that equal its ``where`` (as earlier decisions have left them); a stale one only marks them for review.
    One that names a column that the table lacks does nothing and is reported. Values are text, and take the columns' types; one that has no such value never matches, and sets NULL.

    Columns that no decision changes tell which decisions a row meets: an equi-join for each set of such columns, against one row a key. A row then folds its own
    decisions in order. So the plan grows with the sets of columns, not with the decisions, and rows are never multiplied.
    """
    types = dict(table.dtypes)
    unknown = F.array_except(F.array_union(F.map_keys("where"), F.map_keys("set")), F.array(*map(F.lit, table.columns)))
    decisions = decisions.withColumn("unknown_columns", unknown)
    known = decisions.filter(F.size("unknown_columns") == 0)
    forms = known.select(F.map_keys("where").alias("where"), F.map_keys("set").alias("set"), "stale").distinct().collect()  # sets of columns
    changed = {c for f in forms if not f.stale for c in (*f.set, "matching_rule_id")} | {c for f in forms if f.stale for c in ("override_stale", "verification_status")}
    if not forms:
        return table, decisions.select("id", "stale", "unknown_columns", F.lit(0).cast("long").alias("rows"))
    held = lambda k: k.isin(*changed)
    entry = F.struct("order", "stale", F.map_filter("where", lambda k, v: held(k)).alias("where"), "set")
    keys = F.array_sort(F.filter(F.map_keys("where"), lambda k: ~held(k)))
    met, out = [], table
    for n, columns in enumerate(sorted({tuple(sorted(set(f.where) - changed)) for f in forms})):
        mine = f"decisions {n}"
        rows = known.filter(keys == F.array(*map(F.lit, columns)).cast("array<string>"))
        named = {f"key {n} {c}": F.col("where")[c].try_cast(types[c]) for c in columns}
        side = rows.withColumns(named).groupBy(*named).agg(F.collect_list(entry).alias(mine))
        on = [F.col(f"`{c}`") == F.col(f"key {n} {c}") for c in columns]
        out = out.join(side, on, "left").drop(*named) if on else out.join(F.broadcast(side), how="cross")  # a row without a key is the only one
        met.append(F.coalesce(mine, F.array().cast(side.schema[mine].dataType)))
    ordered = F.array_sort(F.concat(*met), lambda a, b: (a["order"] - b["order"]).cast("int"))
    names = sorted(changed)
    start = F.struct(*[F.col(f"`{c}`").alias(c) for c in names], F.array().cast("array<bigint>").alias("decisions that hit"))

    def step(s, d):
        given = lambda m, c: d[m][c].try_cast(types[c])
        equal = [F.when(F.map_contains_key(d["where"], F.lit(c)), F.coalesce(s[c] == given("where", c), F.lit(False))).otherwise(True) for c in names]
        hit = reduce(lambda a, b: a & b, equal)
        marks = {"override_stale": "true", "verification_status": "review_required"}

        def value(c):
            v = F.when(hit & d["stale"], F.lit(marks[c]).try_cast(types[c])) if c in marks else F.when(hit & d["stale"], s[c])
            if c == "matching_rule_id":
                return v.when(hit, F.lit("manual_override")).otherwise(s[c])
            return v.when(hit & F.map_contains_key(d["set"], F.lit(c)), given("set", c)).otherwise(s[c])

        hits = F.when(hit, F.concat(s["decisions that hit"], F.array(d["order"]))).otherwise(s["decisions that hit"])
        return F.struct(*[value(c).cast(types[c]).alias(c) for c in names], hits.alias("decisions that hit"))

    out = out.withColumn("after all", F.aggregate(ordered, start, step))
    done = out.select(*[F.col("after all")[c].alias(c) if c in changed else F.col(f"`{c}`") for c in table.columns])
    hits = out.select(F.explode(F.col("after all")["decisions that hit"]).alias("order")).groupBy("order").agg(F.count("*").alias("rows"))
    report = decisions.join(hits, "order", "left").orderBy("order").select("id", "stale", "unknown_columns", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
    return done, report


def stale_report(report: DataFrame) -> DataFrame:
    """(id, reason, rows) of the decisions in a report of ``apply_decisions`` that were not applied: a column is absent, no row matches, or the source has changed (then its rows are marked)."""
    reason = F.when(F.size("unknown_columns") > 0, "a column is absent").when(F.col("rows") == 0, "no row matches").when(F.col("stale"), "the source has changed")
    return report.select("id", reason.alias("reason"), "rows").filter("reason IS NOT NULL")


def apply_overrides(table: DataFrame, overrides: list[dict], shas: dict[str, str]) -> tuple[DataFrame, list[dict]]:
    """``apply_decisions`` of overrides from a file; the report, a row an override, comes to the driver."""
    if not overrides:
        return table, []
    out, report = apply_decisions(table, decision_rows(table.sparkSession, overrides, shas))
    return out, [r.asDict() for r in report.collect()]


def judge_aliases(aliases: DataFrame, names: DataFrame, parsed: DataFrame) -> DataFrame:
    """(id, code_name_differs, forbidden_exists, source_corrected, applies) of aliases (id, code, expected_name, forbidden_name, source, area, published).

    ``names`` (code, name) are today's; ``parsed`` (source, area, published) is what the sources say, as parsed names and not substrings. A lapsed
    precondition makes the alias lapse; it is never guessed around.
    """
    now = names.select("code", F.col("name").alias("now"))
    taken = names.select(F.col("name").alias("forbidden_name")).distinct().withColumn("taken", F.lit(True))
    said = parsed.select("source", "area", "published").distinct().withColumn("said", F.lit(True))
    j = aliases.join(now, "code", "left").join(taken, "forbidden_name", "left").join(said, ["source", "area", "published"], "left")
    differs = F.col("expected_name").isNotNull() & ~F.col("now").eqNullSafe(F.col("expected_name"))
    exists, corrected = F.coalesce("taken", F.lit(False)), F.col("said").isNull()
    return j.select("id", differs.alias("code_name_differs"), exists.alias("forbidden_exists"), corrected.alias("source_corrected"), (~differs & ~exists & ~corrected).alias("applies"))


def gate(metrics: DataFrame, thresholds: DataFrame, approved: DataFrame) -> DataFrame:
    """(metric, value, verdict): ``thresholds`` (metric, warn, fail), ``approved`` (metric, value): one-shot exact values that pass."""
    j = metrics.join(thresholds, "metric", "left").join(approved.select("metric", "value").distinct().withColumn("ok", F.lit(True)), ["metric", "value"], "left")
    verdict = F.when(F.col("ok"), "approved").when(F.col("value") > F.col("fail"), "fail").when(F.col("value") > F.col("warn"), "warn").otherwise("pass")
    return j.select("metric", "value", verdict.alias("verdict"))


def diff_keys(current: DataFrame, previous: DataFrame, key: str, samples: int = 25) -> dict:
    """Counts of keys added and removed, with the first few in order. The tables meet once; keys that differ are written, and counted from there. A NULL is no key."""
    sides = [df.select(F.col(key).alias("key"), F.lit(n).alias("side")) for n, df in ((1, current), (2, previous))]
    met = sides[0].unionByName(sides[1]).filter("key IS NOT NULL").groupBy("key").agg(F.bit_or("side").alias("side"))  # combined where they are read
    differ = durable(met.filter("side <> 3"))
    counts = dict(differ.groupBy("side").count().collect())
    first = lambda side: [r[0] for r in differ.filter(F.col("side") == side).orderBy("key").limit(samples).collect()]
    out = {"added": counts.get(1, 0), "removed": counts.get(2, 0), "added_sample": first(1), "removed_sample": first(2)}
    forget(differ)
    return out


def unexplained_removals(current: DataFrame, previous: DataFrame, explained: DataFrame, key: str) -> DataFrame:
    """Keys of the previous release that are gone without a row in ``explained``."""
    gone = previous.select(key).distinct().join(current.select(key), key, "left_anti")
    return gone.join(explained.select(key), key, "left_anti")


def entity_diff(current: DataFrame, previous: DataFrame, explained: DataFrame, key: str, name: str, code: str) -> DataFrame:
    """One row: added, removed, explained, unexplained, renamed, recoded. Changes from or to NULL are not counted."""
    a = current.select(key, F.col(name).alias("n1"), F.col(code).alias("c1"), F.lit(True).alias("here"))
    b = previous.select(key, F.col(name).alias("n0"), F.col(code).alias("c0"), F.lit(True).alias("was"))
    j = a.join(b, key, "full_outer").join(explained.select(key).distinct().withColumn("known", F.lit(True)), key, "left")
    removed = F.col("here").isNull()
    both = F.col("here") & F.col("was")
    return j.agg(
        F.count_if(F.col("was").isNull()).alias("added"), F.count_if(removed).alias("removed"), F.count_if(removed & F.col("known")).alias("explained"),
        F.count_if(removed & F.col("known").isNull()).alias("unexplained"), F.count_if(both & (F.col("n0") != F.col("n1"))).alias("renamed"), F.count_if(both & (F.col("c0") != F.col("c1"))).alias("recoded"),
    )


def bridge_diff(current: DataFrame, previous: DataFrame, key: str, watched: tuple[str, ...] = ("relation_type", "confidence", "verification_status")) -> DataFrame:
    """One row: edges added, removed, and changed by each watched column."""
    a = current.select(key, *[F.col(c).alias(f"{c}_1") for c in watched], F.lit(True).alias("here"))
    b = previous.select(key, *[F.col(c).alias(f"{c}_0") for c in watched], F.lit(True).alias("was"))
    j = a.join(b, key, "full_outer")
    return j.agg(F.count_if(F.col("was").isNull()).alias("added"), F.count_if(F.col("here").isNull()).alias("removed"), *[F.count_if(F.col(f"{c}_0") != F.col(f"{c}_1")).alias(f"{c}_changed") for c in watched])


def release_diff(current: dict[str, DataFrame], previous: dict[str, DataFrame] | None, keys: dict[str, str], entity: str, explained: DataFrame, name: str, code: str) -> dict:
    """The differences of a release, for ``write_diff``. Without a previous release, a baseline record: the tables and their rows. Entities (table ``entity``) are compared
    by names and codes, tables called ``bridge_...`` by their watched columns, others by keys; a table that one side lacks is told. Removals are not judged here (``check_removals``)."""
    if previous is None:
        return {"baseline": True, "tables": {t: df.count() for t, df in sorted(current.items())}}
    out = {"baseline": False, "tables_added": sorted(set(current) - set(previous)), "tables_removed": sorted(set(previous) - set(current))}
    for t in sorted(set(current) & set(previous)):
        a, b = current[t], previous[t]
        if t == entity:
            out[t] = entity_diff(a, b, explained, keys[t], name, code).first().asDict()
        elif t.startswith("bridge_"):
            watched = tuple(c for c in ("relation_type", "confidence", "verification_status") if c in a.columns and c in b.columns)
            out[t] = bridge_diff(a, b, keys[t], watched).first().asDict()
        else:
            out[t] = diff_keys(a, b, keys[t])
    return out


# Relations and states of a bridge that are counted, and the thresholds of the release-blocking measures (warning from, failure from; both exclusive).
RELATIONS = ("exact", "equivalent", "parent", "child", "overlap", "ambiguous", "unresolved")
STATES = ("auto", "review_required", "manually_verified", "manually_rejected")
THRESHOLDS = {
    "source_rows_pct": (1.0, 5.0), "town_count_pct": (2.0, 2.0), "duplicate_keys": (0.0, 0.0), "required_source_missing": (0.0, 0.0), "unresolved_rise": (1.0, 3.0),
    "ambiguous_rise": (1.0, 3.0), "exact_fall": (1.0, 3.0), "exact_rise": (1.0, 5.0), "removed_unexplained": (0.0, 0.0), "retired_pct": (2.0, 2.0), "invariant_failures": (0.0, 0.0),
}


def bridge_measures(bridge: DataFrame, name: str) -> DataFrame:
    """One row: (bridge, n_rows, a count for each relation and state, candidate_count, the shares exact_pct, ambiguous_pct and unresolved_pct of all rows). NULL shares without rows."""
    n = F.count("*")
    counts = [F.count_if(F.col("relation_type") == r).alias(f"{r}_count") for r in RELATIONS] + [F.count_if(F.col("verification_status") == s).alias(f"{s}_count") for s in STATES]
    shares = [F.try_divide(F.count_if(F.col("relation_type") == r) * F.lit(100.0), n).alias(f"{r}_pct") for r in ("exact", "ambiguous", "unresolved")]
    return bridge.agg(n.alias("n_rows"), *counts, F.coalesce(F.sum(F.col("candidate_count").cast("long")), F.lit(0)).alias("candidate_count"), *shares).select(F.lit(name).alias("bridge"), "*")


def bridge_distributions(bridge: DataFrame, columns: tuple[str, ...] = ("relation_type", "match_method", "matching_rule_id", "verification_status"), confidence: str = "confidence") -> DataFrame:
    """(measure, value, n): rows by each column's values and by tenths of the confidence, in one pass; NULL is a value."""
    tenth = F.when(F.col(confidence).isNull(), None).otherwise(F.format_string("%.1f", F.least(F.lit(0.9), F.floor(F.col(confidence) * 10) / 10)))
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")) for c in columns if c in bridge.columns], F.struct(F.lit(confidence).alias("measure"), tenth.alias("value")))
    return bridge.select(F.explode(pairs).alias("p")).groupBy("p.measure", "p.value").agg(F.count("*").alias("n"))


def source_measures(df: DataFrame, name: str, key: list[str]) -> DataFrame:
    """One row: (source, n_rows, n_keys, n_duplicates, nulls of each column as a map). A row whose key holds a NULL counts as a row, with that key."""
    columns = [c for c in df.columns if c not in key]
    per_key = df.groupBy(*key).agg(F.count("*").alias("the rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c} nulls") for c in columns])
    nulls = [x for c in key for x in (F.lit(c), F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("the rows")).otherwise(0)))] + [x for c in columns for x in (F.lit(c), F.sum(f"`{c} nulls`"))]
    total = F.coalesce(F.sum("the rows"), F.lit(0))
    return per_key.agg(total.alias("n_rows"), F.count("*").alias("n_keys"), (total - F.count("*")).alias("n_duplicates"), F.create_map(*nulls).alias("nulls")).select(F.lit(name).alias("source"), "*")


def release_measures(now: dict[str, DataFrame], before: dict[str, DataFrame], required: list[str], invariant_failures: int = 0) -> DataFrame:
    """(metric, subject, value) of the release-blocking measures.

    Both releases hold ``sources`` (source, n_rows, n_duplicates), ``bridges`` (bridge, rule_version, exact_pct, ambiguous_pct, unresolved_pct) and ``towns`` (id); ``now`` also
    holds ``explained`` (id): the towns whose removal has evidence. A source or bridge that one release lacks has no change; a rise of the exact share counts only
    under the same rule version.
    """
    spark = now["sources"].sparkSession
    named = lambda df, metric, subject, value: df.select(F.lit(metric).alias("metric"), F.col(subject).cast("string").alias("subject"), value.cast("double").alias("value"))
    pct = lambda new, old: F.try_divide((new - old) * F.lit(100.0), old)
    sources = now["sources"].join(before["sources"].select("source", F.col("n_rows").alias("was")), "source", "left")
    out = [named(sources.filter("was IS NOT NULL"), "source_rows_pct", "source", F.coalesce(F.abs(pct(F.col("n_rows"), F.col("was"))), F.when(F.col("n_rows") > 0, 100.0).otherwise(0.0)))]
    out.append(named(sources, "duplicate_keys", "source", F.col("n_duplicates")))
    wanted = spark.createDataFrame([(s,) for s in required], "source string")
    there = now["sources"].select("source", F.lit(0).alias("absent")).distinct()
    out.append(named(wanted.join(there, "source", "left"), "required_source_missing", "source", F.coalesce("absent", F.lit(1))))
    shares = ["exact_pct", "ambiguous_pct", "unresolved_pct"]
    bridges = now["bridges"].join(before["bridges"].select("bridge", F.col("rule_version").alias("version_was"), *[F.col(c).alias(f"{c}_was") for c in shares]), "bridge")
    rise = lambda c: F.col(f"{c}_pct") - F.col(f"{c}_pct_was")
    out += [named(bridges, "unresolved_rise", "bridge", rise("unresolved")), named(bridges, "ambiguous_rise", "bridge", rise("ambiguous")), named(bridges, "exact_fall", "bridge", -rise("exact"))]
    out.append(named(bridges.filter(F.col("rule_version").eqNullSafe(F.col("version_was"))), "exact_rise", "bridge", rise("exact")))
    a, b = now["towns"].select("id", F.lit(1).alias("here")).distinct(), before["towns"].select("id", F.lit(1).alias("was")).distinct()
    both = a.join(b, "id", "full_outer").join(now["explained"].select("id", F.lit(1).alias("known")).distinct(), "id", "left")
    lost = F.col("here").isNull()
    towns = both.agg(F.count("here").alias("n"), F.count("was").alias("n_was"), F.count_if(lost & F.col("known").isNull()).alias("lost"), F.count_if(lost & F.col("known").isNotNull()).alias("retired")).withColumn("towns", F.lit("towns"))
    out += [named(towns, "town_count_pct", "towns", F.coalesce(F.abs(pct(F.col("n"), F.col("n_was"))), F.lit(0.0))), named(towns, "removed_unexplained", "towns", F.col("lost"))]
    out.append(named(towns, "retired_pct", "towns", F.coalesce(F.try_divide(F.col("retired") * F.lit(100.0), F.col("n_was")), F.lit(0.0))))
    out.append(spark.createDataFrame([("invariant_failures", "all", float(invariant_failures))], "metric string, subject string, value double"))
    return reduce(DataFrame.unionByName, out)


def release_gates(measures: DataFrame, approved: DataFrame, versions: DataFrame, thresholds: dict[str, tuple[float, float]] = THRESHOLDS) -> DataFrame:
    """(metric, subject, value, verdict): ``measures`` against the thresholds, each compared beyond its bound.

    ``approved`` (subject, metric, old_version, new_version, expected, tolerance): moves that a person has approved, once: they hold only for the very rule versions that
    ``versions`` (subject, old_version, new_version) has now. A NULL measure is ``unknown``; a measure without a threshold is an error.
    """
    spark = measures.sparkSession
    limits = spark.createDataFrame([(k, float(w), float(f)) for k, (w, f) in thresholds.items()], "metric string, warn double, fail double")
    moves = approved.join(versions, ["subject", "old_version", "new_version"], "left_semi").select("subject", "metric", "expected", "tolerance")
    stop = F.raise_error(F.concat(F.lit("[VALIDATION_FAILED] no threshold for "), F.col("metric"))).cast("string")
    j = measures.join(F.broadcast(limits), "metric", "left").join(moves, ["subject", "metric"], "left")
    near = F.abs(F.col("value") - F.col("expected")) <= F.col("tolerance")
    hit = F.coalesce(F.max(near.cast("int")), F.lit(0)) == 1
    verdict = F.when(F.col("fail").isNull(), stop).when(F.col("value").isNull(), "unknown").when(F.col("ok"), "approved").when(F.col("value") > F.col("fail"), "fail").when(F.col("value") > F.col("warn"), "warn").otherwise("pass")
    return j.groupBy("metric", "subject", "value", "warn", "fail").agg(hit.alias("ok")).select("metric", "subject", "value", verdict.alias("verdict"))


def metrics_delta(now: DataFrame, before: DataFrame) -> DataFrame:
    """(metric, value, previous, change, pct_change) of metrics (metric, value) of two releases; a metric that one lacks has NULLs there."""
    j = now.join(before.select("metric", F.col("value").alias("previous")), "metric", "full_outer")
    change = F.col("value") - F.col("previous")
    return j.select("metric", "value", "previous", change.alias("change"), F.round(F.try_divide(change * 100.0, F.col("previous")), 2).alias("pct_change"))


def check_removals(diff: DataFrame) -> None:
    """Unexplained removals tolerate none."""
    lost = diff.first()["unexplained"]
    if lost:
        raise BuildError("DATA_LOSS_SUSPECTED", "entities vanished without an explanation", unexplained=lost)


def multiset_differences(a: DataFrame, b: DataFrame, ignored: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    """Rows, with their numbers, that one table has more often than the other; none if they are equal but for clock columns."""
    columns = [c for c in a.columns if c not in ignored]
    tally = lambda df, sign: df.groupBy(*columns).agg((F.lit(sign) * F.count("*")).alias("surplus"))
    return tally(a, 1).unionByName(tally(b, -1)).groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter("surplus <> 0")


def check_bridge(bridge: DataFrame, methods: tuple[str, ...]) -> None:
    """Row invariants: a settled row has a code and no note; methods come from a closed list."""
    auto = F.col("verification_status") == "auto"
    stop_if_any(bridge.filter(auto & (F.col("mismatch_note").isNotNull() | F.col("lg_code").isNull())), "VALIDATION_FAILED", "settled rows with a note or without a code")
    stop_if_any(bridge.filter(~F.col("match_method").isin(*methods)), "VALIDATION_FAILED", "unknown match methods")


def check_reference(child: DataFrame, column: str, parent: DataFrame, key: str) -> None:
    lost = child.filter(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
    stop_if_any(lost.select(column), "VALIDATION_FAILED", f"{column} without a row in its table")


def check_unique(df: DataFrame, key: list[str]) -> None:
    stop_if_any(df.groupBy(*key).count().filter("count > 1"), "DUPLICATE_KEY_ANOMALY", f"{', '.join(key)} is not a key")


def coordinate_columns(tables: dict[str, DataFrame], allowed: tuple[str, ...] = ("mlit_town_version",)) -> list[str]:
    """``table.column`` of coordinates in core tables that must not have any."""
    return sorted(f"{t}.{c}" for t, df in tables.items() if t not in allowed for c in df.columns if c in ("longitude", "latitude", "lon", "lat", "geometry"))
