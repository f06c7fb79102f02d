"""Matching rules of the crosswalk. The published rules have ids and outcomes, but no bodies: what stands here is our own reading, under the published ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..durable import durable
from ..functions.normalize import normalize_conservative, normalize_postal_town, normalize_relaxed
from .bridges import By, cascade
from .similarity import nearest_names

#: A municipality, with its prefecture before it or not.
_MUNICIPALITY = r"^(.+?[都道府県])?(.+?[市区町村])$"
#: What ends the list in brackets: only what it names, or all but that.
_KEYWORD = r"(に限る|を除く)。?$"
_TOKEN = r"[（(]|[）)]|、|[^（(）)、]+"


def _named(left: Column, others: DataFrame, right: Column, target: str) -> By:
    """Others of the entity's municipality whose names agree; empty names agree with none."""
    return By({"lg_code": F.col("lg_code"), "the name": F.nullif(left, F.lit(""))}, others.select("lg_code", right.alias("the name"), F.col(target).alias("target")))


def postal(addresses: DataFrame, codes: DataFrame, records: DataFrame) -> DataFrame:
    """Addresses (id, lg_code, machiaza_id, name) to postal codes. ``codes``: lg_code, machiaza_id, postal_code (the registry's own conversion). ``records``: lg_code, town_raw,
    postal_code, record_kind. P1 the conversion of the town's key; P2 the town's name, normalised without brackets; P3 the municipality's special records (no listing,
    whole municipality), which do not name towns, so that their candidates are not complete. Several codes stay, ambiguous; none: unresolved."""
    by_key = By({"lg_code": F.col("lg_code"), "machiaza_id": F.col("machiaza_id")}, codes.select("lg_code", "machiaza_id", F.col("postal_code").alias("target")))
    towns, special = records.filter("record_kind = 'town'"), records.filter("record_kind <> 'town'")
    by_name = _named(normalize_conservative(F.col("name")), towns, normalize_postal_town(F.col("town_raw")), "postal_code")
    by_municipality = By({"lg_code": F.col("lg_code")}, special.select("lg_code", F.col("postal_code").alias("target")))
    return cascade(addresses, [("P1", 1.0, by_key), ("P2", 0.9, by_name), ("P3", 0.3, by_municipality, False)])


def town_reference(addresses: DataFrame, towns: DataFrame, decided: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Addresses (id, lg_code, name) to town reference points (lg_code, mlit_code, name). M0 a person's decision (id, target); M1 the conservative name; M3 the relaxed name
    (one leading 大字 or 字 less on either side). The relaxed profile is used for M3 alone.

    With ``most``, names of one municipality that disagree in up to as many edits come last: M2 where one town is nearest, which a person has to confirm (equivalent), M4 where
    several are (ambiguous).
    """
    exact, relaxed = (_named(profile(F.col("name")), towns, profile(F.col("name")), "mlit_code") for profile in (normalize_conservative, normalize_relaxed))
    rules = [("M1", 1.0, exact), ("M3", 0.8, relaxed)]
    if decided is not None:
        rules = [("M0", 1.0, By({"id": F.col("id")}, decided.select("id", "target"))), *rules]
    if most is None:
        return cascade(addresses, rules)
    plain = normalize_conservative(F.col("name"))
    named = lambda df, *more: df.select(F.col("lg_code").alias("block"), plain.alias("name"), *more).filter("name <> ''")
    targets = named(towns, F.col("mlit_code").alias("target")).withColumnRenamed("name", "other").distinct()
    near = durable(nearest_names(named(addresses), named(towns), most).select("block", "name", "other"))
    near = near.join(targets.hint("merge"), ["block", "other"]).select("block", "name", "target").filter("target IS NOT NULL").distinct()
    near = durable(near.join(near.groupBy("block", "name").agg(F.count("*").alias("n")).hint("merge"), ["block", "name"]))
    nearest = lambda n: By({"block": F.col("lg_code"), "name": plain}, near.filter(n).drop("n"))
    out = cascade(addresses, [*rules, ("M2", 0.6, nearest("n = 1")), ("M4", 0.4, nearest("n > 1"))])
    disagrees = F.col("matching_rule_id") == "M2"
    return out.withColumns({"relation_type": F.when(disagrees, "equivalent").otherwise(F.col("relation_type")), "verification_status": F.when(disagrees, "review_required").otherwise(F.col("verification_status"))})


def _marks(text: Column) -> Column:
    """The words of a text and the brackets that close them, each with its place in the tree: array of (node, path, at, ends, word). ``path`` holds the nodes around it, from the
    outermost; nodes are numbered as they begin; a bracket that closes has no word. A fold over the tokens, with the open nodes as its stack."""
    none = F.array().cast("array<int>")
    mark = "array<struct<node:int,path:array<int>,at:int,ends:int,word:string>>"
    start = F.struct(none.alias("stack"), F.lit(0).alias("item"), F.lit(0).alias("n"), F.lit(0).alias("at"), F.array().cast(mark).alias("out"))

    def step(s, token):
        ends = s["at"] + F.length(token)
        opens, closes = token.isin("（", "("), token.isin("）", ")") & (F.size(s["stack"]) > 0)
        stops = token == "、"
        # a bracket without a name before it has a node without a name
        begins = ~closes & ~stops & (s["item"] == 0)
        node = F.when(closes, F.element_at(s["stack"], -1)).when(begins, s["n"] + 1).otherwise(s["item"])
        outer = F.when(closes, F.slice(s["stack"], F.lit(1), F.size(s["stack"]) - 1)).otherwise(s["stack"])
        word = F.when(opens, F.lit("")).when(~closes, token)
        told = F.struct(node.alias("node"), outer.alias("path"), s["at"].alias("at"), ends.alias("ends"), word.alias("word"))
        return F.struct(
            F.when(opens, F.concat(s["stack"], F.array(node))).otherwise(outer).alias("stack"),
            F.when(opens | stops, F.lit(0)).otherwise(node).alias("item"), F.when(begins, s["n"] + 1).otherwise(s["n"]).alias("n"), ends.alias("at"),
            F.when(stops | (opens & ~begins), s["out"]).otherwise(F.concat(s["out"], F.array(told))).cast(mark).alias("out"),
        )

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step, lambda s: s["out"])


def clause_tree(areas: DataFrame) -> DataFrame:
    """(area_code, node, parent, depth, name, mode, inner, included, raw) of areas (area_code, area_text; codes are unique): a row for each name, bracketed or not.

    ``mode`` tells what a name's bracket does: ``only`` (に限る: just what it names), ``except`` (を除く: all but that), ``note`` (neither), NULL without a bracket; ``inner`` is the
    bracket's text without that word. ``included``: whether what the name stands for is covered, as far as its own bracket lets it: each ``except`` around it turns that over. ``raw`` is
    the text from the name on to its bracket's end, as it is written. Names stand between 、 at every depth. A closing bracket too many is part of a name, one too few ends with the text.
    """
    # marks are many for each area, whatever the size of the areas' files lets a planner expect: made once, and nothing that comes of them is broadcast
    marks = durable(areas.select("area_code", "area_text", F.explode(_marks(F.col("area_text"))).alias("m")).select("area_code", "area_text", "m.*"))
    parent = F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(0))
    marks = marks.withColumn("parent", parent)
    # the last word inside of a bracket may end with what the bracket does
    words = marks.filter("word IS NOT NULL").withColumn("last", F.max("at").over(W.partitionBy("area_code", "parent")))
    ends_list = (F.col("parent") > 0) & (F.col("at") == F.col("last"))
    words = words.withColumn("keyword", F.when(ends_list, F.regexp_extract("word", _KEYWORD, 1)))
    words = words.withColumn("word", F.when(ends_list, F.regexp_replace("word", _KEYWORD, "")).otherwise(F.col("word")))
    inside = words.filter("parent > 0").groupBy("area_code", F.col("parent").alias("node")).agg(F.max("keyword").alias("keyword"), F.min("at").alias("opened"), F.max_by(F.col("at") + F.length("word"), "at").alias("shut"))
    mode = F.when(F.col("keyword") == "に限る", "only").when(F.col("keyword") == "を除く", "except").when(F.col("keyword").isNotNull(), "note")
    inside = inside.select("area_code", "node", mode.alias("mode"), "opened", "shut")
    nodes = marks.filter("word IS NOT NULL").groupBy("area_code", "node").agg(F.min("at").alias("at"), F.min_by("path", "at").alias("path"), F.first("area_text").alias("area_text"))
    last = words.select("area_code", "node", (F.col("at") + F.length("word")).alias("ends")).unionByName(marks.filter("word IS NULL").select("area_code", "node", "ends"))
    ends = last.groupBy("area_code", "node").agg(F.max("ends").alias("ends"))
    names = words.groupBy("area_code", "node").agg(F.min_by("word", "at").alias("name"))
    rows = nodes.join(ends.hint("merge"), ["area_code", "node"]).join(names.hint("merge"), ["area_code", "node"]).join(inside.hint("merge"), ["area_code", "node"], "left")
    around = rows.select("area_code", F.explode("path").alias("outer"), F.col("node").alias("within")).join(inside.select("area_code", F.col("node").alias("outer"), "mode").hint("merge"), ["area_code", "outer"])
    turns = around.groupBy("area_code", F.col("within").alias("node")).agg(F.count_if(F.col("mode") == "except").alias("turns"))
    text = lambda a, b: F.substring(F.col("area_text"), F.col(a) + 1, F.col(b) - F.col(a))
    return rows.join(turns.hint("merge"), ["area_code", "node"], "left").select(
        "area_code", "node", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(0)).alias("parent"), F.size("path").alias("depth"), F.trim("name").alias("name"), "mode",
        F.when(F.col("mode").isNotNull(), text("opened", "shut")).alias("inner"), (F.coalesce("turns", F.lit(0)) % 2 == 0).alias("included"), F.trim(text("at", "ends")).alias("raw"),
    )


def coverage_clauses(areas: DataFrame, tree: DataFrame | None = None) -> DataFrame:
    """(area_code, node, clause_raw, pref_name, municipality_name, qualifier, coverage_type, exception_text) of areas (area_code, area_text): the outermost names of ``clause_tree``. A clause
    that is limited or excepted is ``partial``, and its text is kept as it is, ``exception_text`` being what is taken out; one that is no municipality, or whose bracket does
    neither, is ``unparsed``. ``tree``: the areas' ``clause_tree``, where it is made already."""
    rows = (clause_tree(areas) if tree is None else tree).filter("depth = 0 AND raw <> ''")
    part = lambda n: F.nullif(F.regexp_extract("name", _MUNICIPALITY, n), F.lit(""))
    kind = F.when(part(2).isNull() | (F.col("mode") == "note"), "unparsed").when(F.col("mode").isNotNull(), "partial").otherwise("whole")
    rows = rows.withColumns({"coverage_type": kind, "pref_name": part(1), "municipality_name": part(2)})
    parsed = lambda c: F.when(F.col("coverage_type") != "unparsed", F.col(c))
    return rows.select(
        "area_code", "node", F.col("raw").alias("clause_raw"), parsed("pref_name").alias("pref_name"), parsed("municipality_name").alias("municipality_name"), parsed("inner").alias("qualifier"),
        "coverage_type", F.when(F.col("mode") == "except", parsed("inner")).alias("exception_text"),
    )


def ward_coverage(areas: DataFrame, wards: DataFrame) -> DataFrame:
    """(area_code, municipality_name, ward, coverage) of ``areas`` over all ``wards`` (municipality_name, ward) of the municipalities that they name: ``whole``, ``partial`` or ``none``.

    A ward that a bracket names is as the tree says: covered or not, in part where it has a bracket of its own. One that is not named is covered, unless the bracket is a limit
    to others. Clauses that are unparsed settle no ward.
    """
    tree = durable(clause_tree(areas))
    clauses = coverage_clauses(areas, tree).filter("coverage_type <> 'unparsed'").select("area_code", F.col("node").alias("parent"), "municipality_name")
    modes = tree.filter("depth = 0").select("area_code", F.col("node").alias("parent"), F.col("mode").alias("of_clause"))
    named = tree.filter("depth = 1").groupBy("area_code", "parent", F.col("name").alias("ward")).agg(F.max("included").alias("included"), F.max(F.col("mode").isNotNull()).alias("cut"))
    rows = clauses.join(modes.hint("merge"), ["area_code", "parent"]).join(wards.hint("merge"), "municipality_name").join(named.hint("merge"), ["area_code", "parent", "ward"], "left")
    here = F.when(F.col("included").isNull(), F.when(F.col("of_clause") == "only", 0).otherwise(2)).when(F.col("cut"), 1).when(F.col("included"), 2).otherwise(0)
    out = rows.groupBy("area_code", "municipality_name", "ward").agg(F.max(here).alias("most"))  # several clauses of an area add up
    return out.select("area_code", "municipality_name", "ward", F.element_at(F.array(F.lit("none"), F.lit("partial"), F.lit("whole")), F.col("most") + 1).alias("coverage"))


def telephone(municipalities: DataFrame, coverage: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """Municipalities (id, name) to numbering areas (coverage: area_code, municipality_name, coverage_type). T0 a person's decision (id, target); T1 the one area that covers it whole; T6 several
    areas that each cover it whole, which stay ambiguous; T3 areas that cover parts of it, whose number the clauses do not settle. What no clause names stays, unresolved."""

    name = normalize_conservative(F.col("name"))
    rows = lambda kind: coverage.filter(F.col("coverage_type") == kind).select(normalize_conservative(F.col("municipality_name")).alias("the name"), F.col("area_code").alias("target")).filter("target IS NOT NULL").distinct()
    whole = rows("whole")
    whole = whole.join(whole.groupBy("the name").agg(F.count("*").alias("n")).hint("merge"), "the name")
    by = lambda targets: By({"the name": name}, targets.select("the name", "target"))
    rules = [("T1", 1.0, by(whole.filter("n = 1"))), ("T6", 0.5, by(whole.filter("n > 1"))), ("T3", 0.5, by(rows("partial")), False)]
    if decided is not None:
        rules = [("T0", 1.0, By({"id": F.col("id")}, decided.select("id", "target"))), *rules]
    return cascade(municipalities, rules)


def telephone_of_towns(towns: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """Towns (id) to numbering areas: T0 a person's decision (id, target); all others T10, a row each, unresolved: what is said of a municipality is not carried over to its towns."""
    rules = [] if decided is None else [("T0", 1.0, By({"id": F.col("id")}, decided.select("id", "target")))]
    out = cascade(towns, rules)
    return out.withColumn("matching_rule_id", F.when(F.col("target").isNull(), "T10").otherwise(F.col("matching_rule_id")))
