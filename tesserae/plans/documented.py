"""The documented query set over a release's tables, as DataFrame plans.

``Release`` takes the tables by name (any subset; a query asks for what it needs). ``is_current`` and flags are booleans. Lists that a
query concatenates are in order; top-k and sorts have total orders. Filters stand before joins, on the side that they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.versioning import walk as _walk
from ..operators.versioning import walks as _walks

CENSUS_YEAR = 2025
# Labels of the census tables, and the two-digit prefixes of their age classes.
ALL_NATIONALITIES, BOTH_SEXES = "0_国籍総数", "0_総数"
AGES = {"age_0_14": ("01", "03"), "age_15_64": ("04", "13"), "age_65_plus": ("14", "21"), "age_unknown": ("22", "22")}


def _listed(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def _distinct_if(column: str, value: str) -> Column:
    return F.countDistinct(F.when(F.col("relation_type") == value, F.col(column)))


class Release:
    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def current(self, name: str) -> DataFrame:
        return self[name].filter("is_current")

    def municipalities(self, *more: str) -> DataFrame:
        return self.current("municipality_version").select("lg_code", "pref", "city", "ward", *more)

    def population(self, *columns: str) -> DataFrame:
        return self["census_population_municipality"].filter(F.col("census_year") == CENSUS_YEAR).select("lg_code", *columns)

    def crosswalk(self) -> DataFrame:
        """``address_crosswalk``: a row for each address, postal candidate and town reference candidate (our definition; the view's own is not published)."""
        postal = self["bridge_address_postal_code"].select("address_id", "postal_code", *[F.col(a).alias(f"postal_{b}") for a, b in (("relation_type", "relation_type"), ("matching_rule_id", "rule"), ("confidence", "confidence"), ("candidate_count", "candidate_count"), ("verification_status", "status"))])
        towns = self.current("mlit_town_version").select("mlit_record_id", "mlit_code", F.col("latitude").alias("mlit_latitude"), F.col("longitude").alias("mlit_longitude"))
        mlit = self["bridge_address_mlit"].select("address_id", "mlit_record_id", *[F.col(a).alias(f"mlit_{b}") for a, b in (("relation_type", "relation_type"), ("matching_rule_id", "rule"), ("confidence", "confidence"))])
        names = self["address"].select("address_id", "lg_code", "machiaza_id", F.col("full_name_raw").alias("town_name"))
        return names.join(postal, "address_id", "left").join(mlit.join(towns, "mlit_record_id", "left").drop("mlit_record_id"), "address_id", "left")

    def unmatched(self) -> DataFrame:
        """``unmatched_records``: (kind, id) of unresolved rows of all bridges at hand (our definition)."""
        out = None
        for name in sorted(t for t in self.tables if t.startswith("bridge_") and "relation_type" in self.tables[t].columns):
            rows = self[name].filter("relation_type = 'unresolved'").select(F.lit(name.removeprefix("bridge_")).alias("kind"))
            out = rows if out is None else out.unionByName(rows)
        return out

    def wards(self, lg_code: str) -> DataFrame:
        """A municipality, and the wards of a designated city's parent code (same prefecture and city, with a ward)."""
        m = self.municipalities()
        own = m.filter(F.col("lg_code") == lg_code)
        parent = own.filter("ward IS NULL").select("pref", "city")
        return own.select("lg_code").union(m.filter("ward IS NOT NULL").join(parent, ["pref", "city"]).select("lg_code")).distinct()

    def q01_postal_to_address(self, postal_code: str) -> DataFrame:
        columns = ["town_name", "machiaza_id", "postal_relation_type", "postal_rule", "postal_confidence", "postal_candidate_count", "postal_status"]
        return self.crosswalk().filter(F.col("postal_code") == postal_code).select(*columns).orderBy(*columns[:2])

    def q02_old_postal_to_current(self, old: str) -> DataFrame:
        rows = self.current("postal_record_version").filter(F.col("old_postal_code") == old)
        return rows.select("old_postal_code", "postal_code", "pref", "city", "town", "record_kind").distinct().orderBy("postal_code", "town")

    def q03_old_postal_to_mlit(self, old: str) -> DataFrame:
        codes = self.current("postal_record_version").filter(F.col("old_postal_code") == old).select("old_postal_code", "postal_code")
        return codes.join(self.crosswalk(), "postal_code").select("old_postal_code", "postal_code", "town_name", "mlit_code", "mlit_latitude", "mlit_longitude", "mlit_relation_type", "mlit_rule", "mlit_confidence").orderBy("postal_code", "town_name")

    def _areas(self, *columns: str) -> DataFrame:
        return self.current("telephone_area_version").select("numbering_area_code", "area_code", *columns)

    def q04_postal_to_area_code(self, postal_code: str) -> DataFrame:
        towns = self.crosswalk().filter(F.col("postal_code") == postal_code).select("postal_code", "lg_code").distinct()
        b = self["bridge_municipality_telephone"].select("lg_code", "numbering_area_code", "relation_type", "coverage_type", "confidence")
        return towns.join(b, "lg_code").join(self._areas(), "numbering_area_code").select("postal_code", "area_code", "numbering_area_code", "relation_type", "coverage_type", "confidence").distinct().orderBy("area_code", "numbering_area_code")

    def q05_area_code_to_postal(self, area_code: str) -> DataFrame:
        areas = self._areas().filter(F.col("area_code") == area_code)
        b = self["bridge_municipality_telephone"].select("numbering_area_code", "lg_code", "coverage_type", "matching_rule_id")
        return areas.join(b, "numbering_area_code").join(self.crosswalk().select("lg_code", "postal_code").distinct(), "lg_code").select("area_code", "numbering_area_code", "lg_code", "coverage_type", "matching_rule_id", "postal_code").distinct().orderBy("coverage_type", "postal_code", "lg_code")

    def q06_mlit_to_postal(self, mlit_code: str) -> DataFrame:
        return self.crosswalk().filter(F.col("mlit_code") == mlit_code).select("mlit_code", "town_name", "postal_code", "postal_relation_type", "postal_rule", "postal_confidence").orderBy("postal_code", "town_name")

    def q07_ambiguous(self, limit: int = 100) -> DataFrame:
        columns = ["matching_rule_id", "candidate_group_id", "candidate_count", "address_id", "postal_record_id", "confidence", "verification_status"]
        return self["bridge_address_postal"].filter("relation_type = 'ambiguous'").select(*columns).orderBy(F.desc("candidate_count"), "candidate_group_id", "address_id", "postal_record_id").limit(limit)

    def q08_split_municipalities(self) -> DataFrame:
        b = self["bridge_municipality_telephone"].filter("relation_type <> 'unresolved'")
        sums = b.groupBy("lg_code").agg(F.countDistinct("numbering_area_code").alias("numbering_areas"), _listed("coverage_type").alias("coverage_types")).filter("numbering_areas > 1")
        return sums.join(self.municipalities(), "lg_code").select("lg_code", "pref", "city", "ward", "numbering_areas", "coverage_types").orderBy(F.desc("numbering_areas"), "lg_code")

    def q09_partial_coverage(self) -> DataFrame:
        return self["telephone_area_coverage"].filter("coverage_type = 'partial'").select("numbering_area_code", "pref_name", "municipality_name", "qualifier", "coverage_type", "exception_text", "clause_raw").orderBy("numbering_area_code", "municipality_name")

    def q10_unmatched(self) -> DataFrame:
        return self.unmatched().groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind")

    def q11_postal_multi_town(self, limit: int = 50) -> DataFrame:
        b = self["bridge_address_postal_code"].filter("relation_type <> 'unresolved'")
        return b.groupBy("postal_code").agg(F.countDistinct("address_id").alias("towns")).filter("towns > 1").orderBy(F.desc("towns"), "postal_code").limit(limit)

    def q12_provenance(self, address_id: str) -> DataFrame:
        b = self["bridge_address_postal_code"].filter(F.col("address_id") == address_id).select("bridge_id", "matching_rule_id", "matching_rule_version", "match_run_id")
        s = self["source_snapshot"].select("source_snapshot_id", "dataset_name", "source_version", "downloaded_at", F.substring("sha256", 1, 16).alias("sha256_prefix"), "license_name")
        i = self["match_run_input"].select("match_run_id", "source_snapshot_id", "role")
        return b.join(i, "match_run_id").join(s, "source_snapshot_id").select("bridge_id", "matching_rule_id", "matching_rule_version", "role", "dataset_name", "source_version", "downloaded_at", "sha256_prefix", "license_name").orderBy("role", "dataset_name", "bridge_id")

    def q13_municipality_profile(self, lg_code: str) -> DataFrame:
        """Counts by municipality are aggregated for the one asked for, then joined; a missing count is 0."""
        of = lambda name: self[name].filter(F.col("lg_code") == lg_code)
        counts = [
            of("bridge_station_municipality").groupBy("lg_code").agg(_distinct_if("n02_group_code", "contains").alias("stations"), _distinct_if("n02_group_code", "ambiguous").alias("stations_ambiguous")),
            of("bridge_line_municipality").groupBy("lg_code").agg(F.count_if(F.col("relation_type") == "overlap").alias("lines")),
            of("bridge_bus_stop_municipality").groupBy("lg_code").agg(_distinct_if("p11_stop_id", "contains").alias("bus_stops"), _distinct_if("p11_stop_id", "ambiguous").alias("bus_stops_ambiguous")),
            of("bridge_municipality_postal_code").filter("relation_type <> 'unresolved'").groupBy("lg_code").agg(F.countDistinct("postal_code").alias("postal_codes")),
        ]
        phones = of("bridge_municipality_telephone").filter("relation_type <> 'unresolved'").select("lg_code", "numbering_area_code").join(self._areas(), "numbering_area_code").groupBy("lg_code").agg(_listed("area_code").alias("area_codes"))
        out = self.municipalities().filter(F.col("lg_code") == lg_code).join(self.population("population_total", "households_total", "population_change_5y", "value_status"), "lg_code", "left")
        numbers = []
        for df in counts:
            numbers += df.columns[1:]
            out = out.join(df, "lg_code", "left")
        return out.fillna(0, numbers).join(phones, "lg_code", "left")

    def q14_stations_in_municipality(self, lg_code: str) -> DataFrame:
        s = self["bridge_station_municipality"].filter("verification_status <> 'manually_rejected'").select("lg_code", "n02_group_code", "station_name_raw", "relation_type", "verification_status", "match_method")
        lines = self["bridge_station_line"].select("n02_group_code", "line_name_raw", "operator_name_raw")
        rows = s.join(self.wards(lg_code), "lg_code").join(self.municipalities(), "lg_code").join(lines, "n02_group_code")
        return rows.orderBy("lg_code", "station_name_raw", "operator_name_raw", "line_name_raw").select("city", "ward", "n02_group_code", "station_name_raw", "line_name_raw", "operator_name_raw", "relation_type", "verification_status", "match_method")

    def _on_line(self, table: str, line: str, operator: str) -> DataFrame:
        return self[table].filter((F.col("line_name_raw") == line) & (F.col("operator_name_raw") == operator))

    def q15_municipalities_on_line(self, line: str, operator: str) -> DataFrame:
        b = self._on_line("bridge_line_municipality", line, operator).filter("relation_type = 'overlap'").select("lg_code", "sample_hits", "municipality_count")
        on = self._on_line("bridge_station_line", line, operator).select("n02_group_code").distinct()
        stations = self["bridge_station_municipality"].filter("relation_type = 'contains'").join(on, "n02_group_code").groupBy("lg_code").agg(F.countDistinct("n02_group_code").alias("stations_on_this_line"))
        out = b.join(self.municipalities(), "lg_code").join(stations, "lg_code", "left").join(self.population("population_total"), "lg_code", "left").fillna(0, ["stations_on_this_line"])
        return out.select("lg_code", "pref", "city", "ward", "sample_hits", "municipality_count", "stations_on_this_line", "population_total").orderBy("lg_code")

    def q16_line_stations(self, line: str, operator: str) -> DataFrame:
        s = self["bridge_station_municipality"].filter("verification_status <> 'manually_rejected'").select("n02_group_code", "lg_code", "relation_type", "verification_status", "candidate_count")
        out = self._on_line("bridge_station_line", line, operator).select("n02_group_code", "station_name_raw").join(s, "n02_group_code", "left").join(self.municipalities(), "lg_code", "left")
        return out.select("n02_group_code", "station_name_raw", "lg_code", "pref", "city", "ward", "relation_type", "verification_status", "candidate_count").orderBy("lg_code", "station_name_raw", "n02_group_code")

    def q17_bus_stops_per_capita(self, pref: str) -> DataFrame:
        """Municipalities of a prefecture without designated cities' parents (area level 1)."""
        m = self.municipalities().filter(F.col("pref") == pref).join(self.population("population_total", "area_level"), "lg_code", "left").filter("area_level IS NULL OR area_level <> '1'")
        b = self["bridge_bus_stop_municipality"].groupBy("lg_code").agg(_distinct_if("p11_stop_id", "contains").alias("bus_stops"), _distinct_if("p11_stop_id", "ambiguous").alias("bus_stops_ambiguous"))
        out = m.join(b, "lg_code", "left").fillna(0, ["bus_stops", "bus_stops_ambiguous"])
        rate = F.round(F.try_divide(F.col("bus_stops") * 10000.0, F.col("population_total")), 2)
        return out.select("lg_code", "city", "ward", "bus_stops", "bus_stops_ambiguous", "population_total", rate.alias("stops_per_10k")).orderBy(F.desc("stops_per_10k"), "lg_code")

    def _towns_of_postal(self, postal_code: str) -> DataFrame:
        b = self.current("bridge_address_postal_code").filter((F.col("postal_code") == postal_code) & (F.col("verification_status") != "manually_rejected"))
        return b.select("address_id").join(self["address"].select("address_id", "lg_code", "full_name_raw"), "address_id")

    def q18_postal_to_stations(self, postal_code: str) -> DataFrame:
        s = self["bridge_station_municipality"].filter("verification_status <> 'manually_rejected'").select("lg_code", "n02_group_code", "station_name_raw", "operator_name_raw", "relation_type")
        rows = self._towns_of_postal(postal_code).select("lg_code").distinct().join(self.municipalities(), "lg_code").join(s, "lg_code")
        return rows.select(F.lit(postal_code).alias("postal_code"), "lg_code", "pref", "city", "ward", "n02_group_code", "station_name_raw", "operator_name_raw", "relation_type").orderBy("lg_code", "station_name_raw", "n02_group_code")

    def _edges(self, *more: Column) -> DataFrame:
        names = {"old": "old_lg_code", "new": "new_lg_code", "date": "effective_date", "is_unique": "is_unique_match"}
        return self["municipality_lineage_edge"].select(*[F.col(c).alias(a) for a, c in names.items()], *more)

    def lineage_of_all(self, roots: DataFrame) -> DataFrame:
        """(root, depth, path, lg_code, pref, city, ward, is_current_code, all_unique, population_total): every step of the walks from ``roots`` (code), with its path."""
        whole = _walks(roots, self._edges("event_type"), "event_type")
        # a walk's beginnings are steps too; walks share them
        steps = whole.select("root", F.explode(F.sequence(F.lit(0), F.col("steps").cast("int"))).alias("depth"), "hops").select("root", "depth", F.slice("hops", F.lit(1), F.col("depth")).alias("hops")).distinct()
        told = F.transform("hops", lambda h: F.concat(F.lit(" →("), h["date"], F.lit(" "), h["event_type"], F.lit(") "), h["new"]))
        steps = steps.select(
            "root", "depth", F.concat("root", F.array_join(told, "")).alias("path"), F.coalesce(F.try_element_at("hops", F.lit(-1))["new"], F.col("root")).alias("lg_code"),
            F.forall("hops", lambda h: h["is_unique"]).alias("all_unique"),
        )
        out = steps.join(self.municipalities().withColumn("is_current_code", F.lit(True)), "lg_code", "left").join(self.population("population_total"), "lg_code", "left")
        return out.select("root", "depth", "path", "lg_code", "pref", "city", "ward", F.coalesce("is_current_code", F.lit(False)).alias("is_current_code"), "all_unique", "population_total")

    def q19_lineage_to_current(self, old_lg_code: str) -> DataFrame:
        """Every step of the walks from a code, with its path."""
        root = self["municipality_lineage_edge"].sparkSession.createDataFrame([(old_lg_code,)], "code string")
        return self.lineage_of_all(root).drop("root").orderBy("depth", "lg_code", "path")

    def _ages(self) -> DataFrame:
        a = self["census_population_age"].filter((F.col("census_year") == CENSUS_YEAR) & (F.col("nationality_raw") == ALL_NATIONALITIES))
        return a.withColumn("age", F.substring("age_class_raw", 1, 2))

    @staticmethod
    def _sum_ages(name: str) -> Column:
        return F.sum(F.when(F.col("age").between(*AGES[name]), F.col("population")))

    @classmethod
    def _share_65(cls) -> Column:
        return F.round(F.try_divide(cls._sum_ages("age_65_plus") * 100.0, F.sum(F.when(F.col("age") != "22", F.col("population")))), 1).alias("pct_65_plus")

    def q20_age_structure(self, lg_code: str) -> DataFrame:
        keys = ["region_key", "nationality_raw", "sex_raw"]
        sums = self._ages().filter(F.col("lg_code") == lg_code).groupBy(*keys, "lg_code", "area_name_raw").agg(*[self._sum_ages(n).alias(n) for n in AGES], self._share_65())
        means = self["census_population_age_summary"].filter(F.col("census_year") == CENSUS_YEAR).select(*keys, "mean_age", "median_age")
        return sums.join(means, keys).select("lg_code", "area_name_raw", "sex_raw", *AGES, "pct_65_plus", "mean_age", "median_age").orderBy("sex_raw")

    def q21_aging_by_prefecture(self, pref_code: str) -> DataFrame:
        a = self._ages().filter((F.substring("lg_code", 1, 2) == pref_code) & (F.col("sex_raw") == BOTH_SEXES))
        known = F.sum(F.when(F.col("age") != "22", F.col("population"))).alias("known_age_total")
        return a.groupBy("region_key", "lg_code", "area_name_raw", "area_level_raw").agg(known, self._share_65()).drop("region_key").orderBy(F.desc("pct_65_plus"), "lg_code")

    def q22_unresolved_stations_and_stops(self) -> DataFrame:
        def of(table, kind, key, name):
            rows = self[table].filter("verification_status = 'review_required'")
            # the candidates' list is in order; the other columns are equal within a group, or the least is told
            g = rows.groupBy(F.col(key).alias("id")).agg(F.min(name).alias("name"), F.min("operator_name_raw").alias("operator"), F.min("relation_type").alias("relation_type"), F.min("match_method").alias("match_method"), F.count("*").alias("candidate_rows"), F.array_join(F.array_sort(F.collect_list("lg_code")), ";").alias("candidate_lg_codes"))
            return g.select(F.lit(kind).alias("kind"), *[c for c in g.columns if c != "candidate_lg_codes"], F.nullif(F.col("candidate_lg_codes"), F.lit("")).alias("candidate_lg_codes"))

        both = of("bridge_station_municipality", "station", "n02_group_code", "station_name_raw").unionByName(of("bridge_bus_stop_municipality", "bus_stop", "p11_stop_id", "stop_name_raw"))
        return both.orderBy(F.desc("kind"), "relation_type", "id")

    def q23_municipality_postal_codes(self, lg_code: str) -> DataFrame:
        at = (F.col("lg_code") == lg_code) & (F.col("relation_type") != "unresolved")
        none = F.lit(None).cast("string")
        a = self["bridge_municipality_postal_code"].filter(at).select(F.lit("P2").alias("rule"), "postal_code", none.alias("record_kind"), none.alias("town_raw"), "relation_type", "verification_status")
        v = self.current("postal_record_version").select("postal_record_id", "postal_code", "record_kind", "town_raw")
        b = self["bridge_municipality_postal"].filter(at).select("postal_record_id", "relation_type", "verification_status").join(v, "postal_record_id").select(F.lit("P3").alias("rule"), "postal_code", "record_kind", "town_raw", "relation_type", "verification_status")
        return a.unionByName(b).orderBy(F.desc("rule"), "postal_code")

    def q24_area_code_population(self, area_code: str) -> DataFrame:
        c = self["census_population_numbering_area"].filter(F.col("census_year") == CENSUS_YEAR)
        return self._areas("area_text_raw").filter(F.col("area_code") == area_code).join(c, "numbering_area_code").select("area_code", "area_text_raw", "numbering_area_code", "municipality_count", "population_total", "households_total", "value_status").orderBy("numbering_area_code")

    def q25_source_editions(self) -> DataFrame:
        s = self["source_snapshot"].filter(~F.col("dataset_name").contains("__aggregate_of_"))
        dataset = F.regexp_replace(F.regexp_replace("dataset_name", "[0-9]+$", ""), "_+$", "")
        return s.groupBy("provider", dataset.alias("dataset"), "license_name", "source_page_url").agg(F.count("*").alias("files"), _listed("source_version").alias("source_versions"), F.min("downloaded_at").alias("first_downloaded"), F.max("downloaded_at").alias("last_downloaded")).orderBy("provider", "dataset")

    def q26_schools_by_postal_code(self, postal_code: str) -> DataFrame:
        b = self["bridge_school_address"].select("address_id", "school_code", "relation_type", "postal_check", "verification_status")
        s = self["mext_school"].select("school_code", "school_type_code", "school_type_name", "founder_name", "school_name_raw", "address_raw", "is_active")
        rows = self._towns_of_postal(postal_code).join(b, "address_id").join(s, "school_code").orderBy(F.desc("is_active"), "school_type_code", "school_name_raw")
        return rows.select(F.lit(postal_code).alias("postal_code"), F.col("full_name_raw").alias("town_name"), "school_code", "school_type_name", "founder_name", "school_name_raw", "address_raw", "is_active", "relation_type", "postal_check", "verification_status")

    def q27_schools_in_municipality(self, lg_code: str) -> DataFrame:
        b = self["bridge_school_address"].filter("verification_status <> 'manually_rejected'").join(self.wards(lg_code), "lg_code").select("school_code", "relation_type")
        s = self["mext_school"].filter("is_active").select("school_code", "school_type_code", "school_type_name")
        return b.join(s, "school_code").groupBy("school_type_code", "school_type_name").agg(F.countDistinct("school_code").alias("schools"), _distinct_if("school_code", "located_in").alias("located_in_one_town"), _distinct_if("school_code", "municipality_only").alias("municipality_only")).orderBy("school_type_code")

    def current_codes_of(self, old_lg_code: str) -> DataFrame:
        """Where the walks from a code end."""
        root = self["municipality_lineage_edge"].sparkSession.createDataFrame([(old_lg_code,)], "code string")
        return _walk(root, self._edges())
