"""Adapters: what the payloads of a source must look like, how they are read, what was read.

An adapter's payloads are looked at first (``inspect``), held against the pinned schemas, then read (``parse``) and recorded (``snapshots``). A source that is required must have
all its resources; one that is not may have none, but not some of them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import BuildError
from ..operators.gates import check_unique
from ..operators.points import change_edges, lineage_edges, municipality_changes, succession
from . import readers
from .archives import Limits, SchemaInfo, check_drift, check_magic, mask_digits, read_members
from .binary import read_dbf

# The columns of published files, in their order.
PREF = "lg_code pref pref_kana pref_roma efct_date ablt_date remarks".split()
CITY = "lg_code pref pref_kana pref_roma county county_kana county_roma city city_kana city_roma ward ward_kana ward_roma efct_date ablt_date remarks".split()
TOWN = (
    "lg_code machiaza_id machiaza_type pref pref_kana pref_roma county county_kana county_roma city city_kana city_roma ward ward_kana ward_roma "
    "oaza_cho oaza_cho_kana oaza_cho_roma chome chome_kana chome_number koaza koaza_kana koaza_roma machiaza_dist rsdt_addr_flg rsdt_addr_mtd_code "
    "oaza_cho_aka_flg koaza_aka_code oaza_cho_gsi_uncmn koaza_gsi_uncmn status_flg wake_num_flg efct_date ablt_date src_code post_code remarks"
).split()
POSTAL = "lg_code machiaza_id pref county city ward kyoto_st oaza_cho chome koaza machiaza_dist post_code add_date dlt_date".split()
CHANGES = (
    "事由パターン 支庁・振興局等内郡 支庁・振興局等内郡（ふりがな） 標準地域コード 都道府県 政令市･郡･支庁･振興局等 政令市･郡･支庁･振興局等（ふりがな） "
    "市区町村 市区町村（ふりがな） 廃置分合等施行年月日 改正事由 告示年月日 告示番号"
).split()
BOUNDARY = (
    "KEY_CODE PREF CITY S_AREA PREF_NAME CITY_NAME S_NAME KIGO_E HCODE AREA PERIMETER R2KAxx R2KAxx_ID KIHON1 DUMMY1 KIHON2 KEYCODE1 KEYCODE2 "
    "AREA_MAX_F KIGO_D N_KEN N_CITY KIGO_I KBSUM JINKO SETAI X_CODE Y_CODE KCODE1"
).split()
RAILWAY = "N02_001 N02_002 N02_003 N02_004 N02_005 N02_005c N02_005g".split()
SCHOOLS = [f"P29_{i:03d}" for i in range(1, 10)]
POSTAL_RECORDS = (
    "jis_city_code old_postal_code_raw postal_code pref_kana city_kana town_kana pref city town flag_multi_code flag_koaza_banchi flag_has_chome flag_multi_town update_flag change_reason"
).split()
TOWN_POINTS = "都道府県コード 都道府県名 市区町村コード 市区町村名 大字町丁目コード 大字町丁目名 緯度 経度 原典資料コード 大字・字・丁目区分コード".split()
SCHOOL_CODES = "学校コード 学校種 都道府県番号 設置区分 本分校 学校名 学校所在地 郵便番号 属性情報設定年月日 属性情報廃止年月日 旧学校調査番号 移行後の学校コード".split()
BUS_STOPS = ["P11_001", "P11_002", *[f"P11_003_{i:02d}" for i in range(1, 36)], *[f"P11_004_{i:02d}" for i in range(1, 36)], "P11_005"]
# How a town's name ends that is none, and what kind of record that is.
SPECIAL_TOWNS = {"以下に掲載がない場合": "no_listing", "の次に番地がくる場合": "city_banchi", "一円": "ichien"}


@dataclass(frozen=True)
class Resource:
    """A payload of a source: its pinned schema, the suffix of the members that are read, and what an archive may hold."""

    key: str
    pinned: SchemaInfo
    suffix: str = ".csv"
    limits: Limits = Limits()
    optional: bool = False


def _csv(key: str, columns: list[str], container: str = "zip", members: tuple[str, ...] = (), encoding: str = "utf-8") -> Resource:
    return Resource(key, SchemaInfo(tuple(columns), encoding, container, members, ","))


def _dbf(key: str, columns: list[str], encoding: str, ratio: float = Limits.ratio) -> Resource:
    return Resource(key, SchemaInfo(tuple(columns), encoding, "zip"), ".dbf", Limits(ratio=ratio))


def _found(content: bytes, resource: Resource) -> list[tuple[str, list[str]]]:
    """(member, columns) of a payload's members that are read."""
    pinned = resource.pinned
    if pinned.container == "csv":
        members = [("", content)]
    else:
        check_magic("zip", content)
        members = list(read_members(content, resource.suffix, resource.limits))
    if resource.suffix == ".dbf":
        return [(m, read_dbf(d, pinned.encoding)[0]) for m, d in members]
    codec = "utf-8-sig" if pinned.encoding == "utf-8" else pinned.encoding
    first = [next(iter(readers._csv_rows(d, codec, None, pinned.delimiter or ",")), []) for _, d in members]
    if pinned.has_header:
        return [(m, row) for (m, _), row in zip(members, first, strict=True)]
    names = list(pinned.columns)  # without a header, columns are told by their number only
    return [(m, names if len(row) == len(names) else [f"column {i}" for i in range(len(row))]) for (m, _), row in zip(members, first, strict=True)]


class Adapter:
    """A source. ``payloads`` are paths, or DataFrames (path, content), by resource key."""

    name, required = "", True
    resources: tuple[Resource, ...] = ()

    def __init__(self, spark: SparkSession, payloads: dict[str, str | DataFrame]):
        unknown = sorted(set(payloads) - {r.key for r in self.resources})
        if unknown:
            raise BuildError("VALIDATION_FAILED", f"{self.name} has no such resources", unknown=unknown)
        missing = [r.key for r in self.resources if r.key not in payloads and not r.optional]
        if missing and (self.required or payloads):
            raise BuildError("REQUIRED_SOURCE_MISSING" if self.required else "SOURCE_FETCH_FAILED", f"{self.name} is not whole", missing=missing)
        self.spark, self.payloads = spark, payloads

    def inspect(self) -> dict[str, SchemaInfo]:
        """What each payload looks like. All files of a resource must look alike; those that do not are an error."""
        out = {}
        for resource in self.resources:
            if resource.key not in self.payloads:
                continue

            def look(frames, resource=resource):
                for frame in frames:
                    rows = [(file, m, columns) for file, content in zip(frame["path"], frame["content"], strict=True) for m, columns in _found(bytes(content), resource)]
                    yield pd.DataFrame(rows, columns=["file", "member", "columns"])

            files = readers._files(self.spark, self.payloads[resource.key])
            kinds = files.mapInPandas(look, "file string, member string, columns array<string>").groupBy("columns").agg(F.min("file").alias("file"), F.array_sort(F.collect_set("member")).alias("members")).orderBy("file").limit(3).collect()
            if len(kinds) != 1:
                raise BuildError("SOURCE_SCHEMA_CHANGED", f"{self.name}/{resource.key}: nothing to read, or files that differ", kinds=[(k.file, list(k.columns)) for k in kinds])
            members = sorted({mask_digits(m) for m in kinds[0].members}) if resource.pinned.members else ()
            out[resource.key] = replace(resource.pinned, columns=tuple(kinds[0].columns), members=tuple(members))
        return out

    def check(self) -> dict[str, SchemaInfo]:
        """``inspect``, held against the pinned schemas; any difference stops the build."""
        found = self.inspect()
        for resource in self.resources:
            if resource.key in found:
                check_drift(f"{self.name}/{resource.key}", found[resource.key], resource.pinned)
        return found

    def read(self, key: str) -> DataFrame:
        """The rows of a resource, as text."""
        resource = next(r for r in self.resources if r.key == key)
        pinned, payload = resource.pinned, self.payloads[key]
        if resource.suffix == ".dbf":
            return readers.dbf(self.spark, payload, list(pinned.columns), pinned.encoding, resource.limits)
        codec = "utf-8-sig" if pinned.encoding == "utf-8" else pinned.encoding
        how = (list(pinned.columns), codec, pinned.has_header, pinned.delimiter or ",")
        return readers.plain_csv(self.spark, payload, *how) if pinned.container == "csv" else readers.zip_csv(self.spark, payload, *how, resource.limits)

    def parse(self) -> dict[str, DataFrame]:
        """Tables by name: those of the resources, unless a source makes others of them."""
        return {r.key: self.read(r.key) for r in self.resources if r.key in self.payloads}

    def snapshots(self) -> DataFrame:
        """(source_snapshot_id, source, path, sha256, size, row_count, resource, schema_fingerprint), a row for each file."""
        found, out = self.check(), None
        for key, info in found.items():
            rows = readers.snapshots(self.spark, self.payloads[key], self.name, self.read(key)).withColumns({"resource": F.lit(key), "schema_fingerprint": F.lit(info.fingerprint)})
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            return self.spark.createDataFrame([], "source_snapshot_id string, source string, path string, sha256 string, size long, row_count long, resource string, schema_fingerprint string")
        return out


class AddressMasters(Adapter):
    """Prefectures, municipalities, towns, and the towns' postal codes."""

    name = "address_masters"
    resources = (_csv("pref", PREF), _csv("city", CITY), _csv("town", TOWN), _csv("postal", POSTAL))


class MunicipalityChanges(Adapter):
    """Changes of municipalities: all of them, those that create codes, those that abolish codes."""

    name, required = "municipality_changes", False
    resources = tuple(_csv(k, CHANGES, "csv") for k in ("changes", "changes_created", "changes_abolished"))

    def parse(self) -> dict[str, DataFrame]:
        if not self.payloads:
            return {}
        whole, created, abolished = (self.read(r.key).drop("source_file", "member", "row_ordinal").replace("", None) for r in self.resources)
        at = ("標準地域コード", "廃置分合等施行年月日", "改正事由")
        marked = municipality_changes(whole, created, abolished, *at)
        return {"municipality_change": marked, "lineage_edge": lineage_edges(change_edges(marked, *at))}


class Boundaries(Adapter):
    """Small areas, a file for each prefecture."""

    name = "boundaries"
    resources = (_dbf("areas", BOUNDARY, "cp932"),)

    def parse(self) -> dict[str, DataFrame]:
        kept = self.read("areas").select("source_file", "member", "row_ordinal", *[F.col(c).alias(c.lower()) for c in ("KEY_CODE", "PREF", "CITY", "S_NAME", "HCODE", "KIGO_D", "JINKO", "SETAI")])
        return {"areas": kept.withColumn("municipality_code", readers.joined_key("pref", "city"))}


class Railways(Adapter):
    """Railway lines and stations."""

    name, required = "railways", False
    resources = (_dbf("features", RAILWAY, "utf-8"),)


class SchoolPoints(Adapter):
    """Schools: attributes, and points by the same index."""

    name, required = "school_points", False
    resources = (_dbf("schools", SCHOOLS, "utf-8", ratio=400),)  # most of the table is blanks of fixed width

    def parse(self) -> dict[str, DataFrame]:
        """Attributes with the point of the same place in the file, NULL where the shape is null; a file that has not as many shapes as rows, or a campus (school, campus code)
        that occurs twice, is an error."""
        if not self.payloads:
            return {}
        place = ["source_file", "folder", "row_ordinal"]
        folder = F.regexp_replace("member", r"\.[^./]*$", "")
        rows = self.read("schools").withColumn("folder", folder)
        points = readers.shapes(self.spark, self.payloads["schools"], expect=1, limits=self.resources[0].limits).withColumn("folder", folder).select(*place, F.col("x0").alias("x"), F.col("y0").alias("y"), F.lit(True).alias("there"))
        paired = rows.withColumn("here", F.lit(True)).join(points, place, "full_outer")
        stop = F.raise_error(F.lit("[SOURCE_SCHEMA_CHANGED] attributes and points differ in number")).cast("boolean")
        paired = paired.filter(F.when(F.col("here").isNull() | F.col("there").isNull(), stop).otherwise(F.lit(True))).drop("here", "there", "folder")
        check_unique(paired, ["P29_002", "P29_008"])
        return {"schools": paired}


def _no_header(key: str, optional: bool = False) -> Resource:
    return Resource(key, SchemaInfo(tuple(POSTAL_RECORDS), "utf-8", "zip", (), ",", has_header=False), optional=optional)


class PostalRecords(Adapter):
    """Postal records: the whole, and what a month added and deleted."""

    name = "postal_records"
    resources = (_no_header("ken_all"), _no_header("delta_add", optional=True), _no_header("delta_del", optional=True))

    def parse(self) -> dict[str, DataFrame]:
        """``ken_all`` with the old code without the blanks at its right (zeros stay) and the kind of record, told by how the town's name ends; ``delta``: the rows of a
        month, ``action`` being add or del."""
        kind = reduce(lambda k, s: k.when(F.col("town").endswith(s), SPECIAL_TOWNS[s]), SPECIAL_TOWNS, F.when(F.lit(False), "")).otherwise("town")
        out = {"ken_all": self.read("ken_all").withColumns({"old_postal_code": F.rtrim("old_postal_code_raw"), "record_kind": kind})}
        deltas = [self.read(f"delta_{a}").withColumn("action", F.lit(a)) for a in ("add", "del") if f"delta_{a}" in self.payloads]
        return out | ({"delta": reduce(DataFrame.unionByName, deltas)} if deltas else {})


def rolled_forward(records: DataFrame, delta: DataFrame) -> DataFrame:
    """Postal records after a month's ``delta`` (with ``action``): rows are added and taken out as often as they are named, by all published columns. A row to be taken out that
    is not there, as often as named, is an error: the two do not belong together."""
    tally = lambda df, n: df.groupBy(*POSTAL_RECORDS).agg(F.sum(n).alias("n"))
    both = tally(records, F.lit(1)).unionByName(tally(delta, F.when(F.col("action") == "add", 1).otherwise(-1))).groupBy(*POSTAL_RECORDS).agg(F.sum("n").alias("n"))
    stop = F.raise_error(F.lit("[VALIDATION_FAILED] a deleted postal record was not there")).cast("boolean")
    left = both.filter(F.when(F.col("n") < 0, stop).otherwise(F.col("n") > 0))
    return left.select(*POSTAL_RECORDS, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).drop("copy")


class TownPoints(Adapter):
    """Reference points of towns, a file for each prefecture."""

    name = "town_points"
    resources = (_csv("towns", TOWN_POINTS, encoding="cp932"),)

    def parse(self) -> dict[str, DataFrame]:
        """Codes as text, coordinates as numbers; a coordinate that is none is NULL."""
        names = "pref_code pref city_code city mlit_code town_name latitude longitude source_code class_code".split()
        rows = self.read("towns").withColumnsRenamed(dict(zip(TOWN_POINTS, names, strict=True)))
        return {"towns": rows.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")})}


class SchoolCodes(Adapter):
    """Codes of all schools: the east, the west, universities. One of the three alone is not the country."""

    name, required = "school_codes", False
    resources = tuple(_csv(k, SCHOOL_CODES, "csv", encoding="cp932") for k in ("east", "west", "university"))

    def parse(self) -> dict[str, DataFrame]:
        """``school``, each row with the resource that it is from, and ``school_succession``, the edges to the codes that it moved to. A code that occurs twice is an error."""
        if not self.payloads:
            return {}
        names = "school_code school_type_code pref_number founder_code branch school_name_raw address_raw postal_code valid_from valid_to survey_number successor_school_codes_raw".split()
        rows = reduce(DataFrame.unionByName, [self.read(r.key).withColumn("resource", F.lit(r.key)) for r in self.resources]).withColumnsRenamed(dict(zip(SCHOOL_CODES, names, strict=True)))
        check_unique(rows, ["school_code"])
        return {"school": rows.withColumn("is_active", F.trim("valid_to") == ""), "school_succession": succession(rows)}


class BusStops(Adapter):
    """Bus stops: attributes in archives of their own, and points by the same index."""

    name, required = "bus_stops", False
    resources = (_dbf("stops", BUS_STOPS, "cp932", ratio=400),)

    def parse(self) -> dict[str, DataFrame]:
        """``stops`` (p11_stop_id, stop_name_raw, operator_name_raw, x, y) and ``stop_operators`` (p11_stop_id, place, operator, routes): up to 35 operators stand in columns beside each
        other; those that are filled become rows. The id depends on the file and the place in it."""
        if not self.payloads:
            return {}
        place = ["source_file", "folder", "row_ordinal"]
        folder = F.regexp_replace("member", r"\.[^./]*$", "")
        rows = self.read("stops").withColumn("folder", folder)
        points = readers.shapes(self.spark, self.payloads["stops"], expect=1, limits=self.resources[0].limits).withColumn("folder", folder)
        paired = rows.withColumn("here", F.lit(True)).join(points.select(*place, F.col("x0").alias("x"), F.col("y0").alias("y"), F.lit(True).alias("there")), place, "full_outer")
        stop = F.raise_error(F.lit("[SOURCE_SCHEMA_CHANGED] attributes and points differ in number")).cast("boolean")
        paired = paired.filter(F.when(F.col("here").isNull() | F.col("there").isNull(), stop).otherwise(F.lit(True)))
        stop_id = F.concat(F.lit("p11_"), F.substring(F.sha2(F.concat_ws("\x1f", "folder", F.col("row_ordinal").cast("string")), 256), 1, 16))
        stops = paired.select(stop_id.alias("p11_stop_id"), F.trim("P11_001").alias("stop_name_raw"), F.trim("P11_002").alias("operator_name_raw"), "x", "y")
        pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.trim(f"P11_003_{i:02d}").alias("operator"), F.trim(f"P11_004_{i:02d}").alias("routes")) for i in range(1, 36)])
        operators = paired.select(stop_id.alias("p11_stop_id"), F.explode(F.filter(pairs, lambda p: (p["operator"] != "") | (p["routes"] != ""))).alias("p")).select("p11_stop_id", "p.*")
        return {"stops": stops, "stop_operators": operators}
