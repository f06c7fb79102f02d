"""Versions from release to release (SCD-2), field history, identity, lineage walks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import durable, forget
from ..errors import stop_if_any

CLOCK = ("observed_from", "observed_to", "is_current", "source_snapshot_id", "match_run_id", "created_at", "updated_at")


def content_hash(columns: list[str]) -> Column:
    """SHA-256 over columns in the order given; NULL and empty differ."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("0")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *cells), 256)


def carry_forward(current: DataFrame, previous: DataFrame | None, key: str, id_col: str, stamp: str) -> DataFrame:
    """Version rows of this release.

    ``current`` holds open rows (``observed_from`` = the stamp of this build); ``previous`` all rows of the last release, or None for the first.
    Same content (all but id, clock and provenance): the old row goes on. Changed: the old row closes and the new one opens. Vanished: closes.
    Closed rows stay. An interval never ends before it began, and a successor opens where its predecessor closed; so two changes in a
    day, or a stamp older than the last release's, still give intervals that follow each other.
    """
    if previous is None:
        return current
    columns = current.columns
    content = [c for c in columns if c not in (*CLOCK, id_col, key)]
    closed = previous.filter(~F.col("is_current")).select(columns)
    held = previous.filter("is_current").select(F.col(key).alias("k"), F.struct(*columns).alias("p"), content_hash(content).alias("ph"))
    new = current.select(F.col(key).alias("k"), F.struct(*columns).alias("c"), content_hash(content).alias("ch"))
    both = held.join(new, "k", "full_outer")
    end = F.greatest(F.lit(stamp), F.col("p.observed_from"))
    same = F.col("ph") == F.col("ch")

    def row(source: str, changed: dict[str, Column]) -> Column:
        return F.struct(*[changed.get(c, F.col(f"{source}.{c}")).alias(c) for c in columns])

    shut = row("p", {"observed_to": end, "is_current": F.lit(False)})
    opened = row("c", {"observed_from": F.when(F.col("p").isNotNull(), end).otherwise(F.col("c.observed_from"))})
    rows = (
        F.when(F.col("p").isNull(), F.array(F.col("c")))
        .when(F.col("c").isNull(), F.array(shut))
        .when(same, F.array(F.col("p")))
        .otherwise(F.array(shut, opened))
    )
    return both.select(F.explode(rows).alias("r")).select("r.*").unionByName(closed)


def field_history(current: DataFrame, previous: DataFrame | None, key: str, fields: list[str]) -> DataFrame:
    """(history_id, key, field, old_value, new_value): a row for each field that changed; a change from or to NULL is not counted."""
    if previous is None:
        previous = current.limit(0)
    old = previous.select(key, *[F.col(f).cast("string").alias(f"old_{f}") for f in fields])
    new = current.select(key, *[F.col(f).cast("string").alias(f"new_{f}") for f in fields])
    changes = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"old_{f}").alias("old_value"), F.col(f"new_{f}").alias("new_value")) for f in fields])
    rows = old.join(new, key).select(key, F.explode(changes).alias("c")).select(key, "c.*").filter("old_value <> new_value")
    return rows.select(F.concat(F.lit("his_"), F.substring(content_hash([key, "field", "old_value", "new_value"]), 1, 16)).alias("history_id"), key, "field", "old_value", "new_value")


def mint(*parts: Column) -> Column:
    """A persistent id: a prefix and 16 characters that depend on all parts, leading zeros included (our own layout)."""
    return F.concat(F.lit("tsr1"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16))


# The digits of base 32 that are not mistaken for one another (no i, l, o, u).
BASE32 = "0123456789abcdefghjkmnpqrstvwxyz"


def mint_base32(prefix: str, *parts: Column) -> Column:
    """A persistent id of ``prefix`` and 16 digits of base 32: the first 80 bits of the parts' SHA-256. It shows nothing of the parts, and depends on every character of them."""
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)
    chunk = lambda i: F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("long")
    digit = lambda i, k: F.substring(F.lit(BASE32), (F.shiftright(chunk(i), 5 * k) % 32 + 1).cast("int"), F.lit(1))
    return F.concat(F.lit(prefix), *[digit(i, k) for i in range(4) for k in (3, 2, 1, 0)])


def resolve_identity(towns: DataFrame, ledger: DataFrame, recodes: DataFrame) -> DataFrame:
    """(area, code, name, entity_id, rule, review): which persistent id each town of this release has; no id goes to two towns.

    ``towns``: area, code, name. ``ledger``: entity_id, area, code, name, active. ``recodes``: old_area, new_area, attested by a person.
    I1 key unchanged; I4 key unchanged, renamed. A new town claims the vanished entities of its area and name (I2: the code was corrected), and those of its
    code and name whose area was recoded to its own, by attestation only (I3). It gets the one entity that it claims, if no other town claims that, by
    whichever rule. Else it is minted: I5 new, I6 a retired key is back (always with a review). Reviews: ``I2_ambiguous`` and ``I3_ambiguous`` where claims
    do not settle, ``I3_renamed`` where only the name speaks against an attested recode, ``I3_unattested`` where only the attestation is missing.
    """
    key = ["area", "code"]
    live, gone = ledger.filter("active"), ledger.filter("NOT active")
    by_key = towns.join(live.select(*key, F.col("entity_id").alias("same"), F.col("name").alias("was")).hint("merge"), key, "left")
    kept = by_key.filter("same IS NOT NULL").select(*key, "name", F.col("same").alias("entity_id"), F.when(F.col("was") == F.col("name"), "I1").otherwise("I4").alias("rule"), F.lit(None).cast("string").alias("review"))
    new = by_key.filter("same IS NULL").select(*key, "name")
    vanished = live.join(towns.select(*key).hint("merge"), key, "left_anti").select("entity_id", *key, "name")
    recoded = vanished.join(recodes.withColumnRenamed("old_area", "area"), "area").select("entity_id", F.col("new_area").alias("area"), "code", "name")
    # Claims are pairs, and as many as the square of a group of one name; but one claim is told from several by the least and the greatest of a group, so no pair is made.
    groups = {"I2": (vanished.drop("code"), ["area", "name"]), "I3": (recoded, ["area", "code", "name"])}
    of_town, of_entity = None, None
    for by, (claimed, on) in groups.items():
        ids = claimed.filter("entity_id IS NOT NULL").groupBy(*on).agg(F.min("entity_id").alias("least"), F.max("entity_id").alias("most"))
        claims = new.filter("code IS NOT NULL").join(ids.hint("merge"), on).select(*key, "least", "most", F.lit(by).alias("by"))
        of_town = claims if of_town is None else of_town.unionByName(claims)
        claimants = new.filter("code IS NOT NULL").groupBy(*on).agg(F.min(F.struct(*key)).alias("first"), F.max(F.struct(*key)).alias("last"))
        rows = claimed.filter("entity_id IS NOT NULL").join(claimants.hint("merge"), on).select("entity_id", "first", "last")
        of_entity = rows if of_entity is None else of_entity.unionByName(rows)
    alone = of_entity.groupBy(F.col("entity_id").alias("claim")).agg((F.min("first") == F.max("last")).alias("alone"))
    of_town = of_town.groupBy(*key).agg(F.min("least").alias("claim"), F.max("most").alias("other"), F.min("by").alias("by"))
    of_town = of_town.join(alone.hint("merge"), "claim", "left").select(*key, "claim", "by", (F.col("claim") == F.col("other")).alias("one"), "alone")
    renamed = recoded.select(*key).distinct().withColumn("renamed", F.lit(True))
    elsewhere = vanished.select("code", "name").distinct().withColumn("elsewhere", F.lit(True))
    retired = gone.groupBy(*key).agg(F.count("*").alias("retired"))
    new = new.join(of_town.hint("merge"), key, "left").join(renamed.hint("merge"), key, "left").join(elsewhere.hint("merge"), ["code", "name"], "left").join(retired.hint("merge"), key, "left")
    # an id that the ledger has given before, to whichever key, is not given again
    minted = new.withColumn("minted", mint(F.col("area"), F.col("code"), F.coalesce(F.concat(F.lit("again"), F.col("retired").cast("string")), F.lit("first"))))
    given = ledger.select(F.col("entity_id").alias("minted"), F.lit(True).alias("given")).distinct()
    minted = minted.join(given.hint("merge"), "minted", "left").withColumn("minted", F.when(F.col("given"), mint(F.col("minted"), F.lit("given"))).otherwise(F.col("minted")))
    settled = F.coalesce(F.col("one") & F.col("alone"), F.lit(False))
    review = (
        F.when(settled, None).when(F.col("claim").isNotNull(), F.concat("by", F.lit("_ambiguous")))
        .when(F.col("retired").isNotNull(), "I6_reinstatement_candidate").when(F.col("renamed"), "I3_renamed").when(F.col("elsewhere"), "I3_unattested")
    )
    return kept.unionByName(minted.select(
        *key, "name", F.when(settled, F.col("claim")).otherwise(F.col("minted")).alias("entity_id"),
        F.when(settled, F.col("by")).when(F.col("retired").isNotNull(), "I6").otherwise("I5").alias("rule"), review.alias("review"),
    ))


#: What a rule of identity says of an entity's line.
LINEAGE = {"I2": "code_corrected", "I3": "municipality_recoded", "I4": "renamed"}


def identity_lineage(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    """(entity_id, relation_type, old_area, old_code, old_name, area, code, name): a row for each entity that was renamed, whose code was corrected, whose area was
    recoded, or that was retired in this release (then without a present key)."""
    was = ledger.filter("active").select("entity_id", *[F.col(c).alias(f"old_{c}") for c in ("area", "code", "name")])
    rows = was.join(resolved.select("entity_id", "area", "code", "name", "rule").hint("merge"), "entity_id", "left")
    relation = F.when(F.col("rule").isNull(), "retired")
    for rule, name in LINEAGE.items():
        relation = relation.when(F.col("rule") == rule, name)
    rows = rows.withColumn("relation_type", relation).filter("relation_type IS NOT NULL")
    return rows.select("entity_id", "relation_type", "old_area", "old_code", "old_name", "area", "code", "name")


def check_identity(resolved: DataFrame) -> None:
    """An id that stands for two towns stops the build."""
    stop_if_any(collisions(resolved), "IDENTITY_COLLISION", "an id stands for more than one town")


def retire(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    """The ledger's rows, all kept; those that no town of this release has are no longer active."""
    seen = resolved.select("entity_id").distinct().withColumn("seen", F.lit(True))
    return ledger.join(seen.hint("merge"), "entity_id", "left").withColumn("active", F.coalesce("seen", F.lit(False))).drop("seen")


def collisions(ids: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Ids that stand for more than one row."""
    return ids.groupBy(id_col).count().filter("count > 1")


def version_id(columns: list[str]) -> Column:
    """``ver_`` and 16 characters of the content's hash: equal content, equal id."""
    return F.concat(F.lit("ver_"), F.substring(content_hash(columns), 1, 16))


def walks(roots: DataFrame, edges: DataFrame, *told: str) -> DataFrame:
    """(root, code, since, all_unique, steps, hops): the walks from ``roots`` (``code``) over ``edges`` (old, new, date, is_unique, and the columns ``told``), to their ends. ``hops`` has each step's
    (old, new, date, is_unique, ...) in order, where columns are told; else it is left out, and walks that agree in the other columns are one.

    A step must be later than the one before and change the code, so each walk ends. A place is a code and the day on which it was reached; what follows from there does not
    depend on the way. So walks are composed: after n rounds each place knows where 2 to the n steps lead, and rounds are the logarithm of the longest walk.
    """
    ahead = edges.filter("old <> new").select("old", "new", "date", "is_unique", *told).distinct()
    starts = roots.select("code", F.lit("").alias("since")).distinct()
    places = starts.unionByName(ahead.select(F.col("new").alias("code"), F.col("date").alias("since"))).distinct()
    first = places.join(ahead, (F.col("code") == F.col("old")) & (F.col("date") > F.col("since")), "left")
    hop = F.array(F.struct("old", "new", "date", "is_unique", *told))
    hops = [F.when(F.col("old").isNull(), F.slice(hop, 1, 0)).otherwise(hop).alias("hops")] if told else []
    reach = durable(first.select(
        "code", "since", F.coalesce("new", "code").alias("to_code"), F.coalesce("date", "since").alias("to_since"), F.coalesce("is_unique", F.lit(True)).alias("all_unique"),
        F.col("old").isNotNull().cast("long").alias("steps"), F.col("old").isNull().alias("ended"), *hops,
    ))
    while not reach.filter("NOT ended").isEmpty():
        on = reach.select(F.col("code").alias("to_code"), F.col("since").alias("to_since"), *[F.col(c).alias(f"on_{c}") for c in reach.columns[2:]])
        both = reach.filter("NOT ended").join(on, ["to_code", "to_since"])
        more = [F.concat("hops", "on_hops").alias("hops")] if told else []
        further = both.select(
            "code", "since", F.col("on_to_code").alias("to_code"), F.col("on_to_since").alias("to_since"), (F.col("all_unique") & F.col("on_all_unique")).alias("all_unique"),
            (F.col("steps") + F.col("on_steps")).alias("steps"), F.col("on_ended").alias("ended"), *more,
        )
        before, reach = reach, durable(reach.filter("ended").unionByName(further).distinct())
        forget(before)
    found = starts.withColumnsRenamed({"code": "root"}).drop("since").join(reach.filter("since = ''").withColumnRenamed("code", "place"), F.col("root").eqNullSafe(F.col("place")))
    return found.select("root", F.col("to_code").alias("code"), F.col("to_since").alias("since"), "all_unique", "steps", *(["hops"] if told else []))


def walk(roots: DataFrame, edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(root, code, since, all_unique): where the ``walks`` end. A caller's own bound of ``rounds`` is an error where a walk has as many steps."""
    found = walks(roots, edges)
    if rounds is not None and (found.agg(F.max("steps")).first()[0] or 0) >= rounds:
        raise RuntimeError(f"walks have not ended in {rounds} rounds")
    return found.select("root", "code", "since", "all_unique").distinct()
