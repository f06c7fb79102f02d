"""The documented queries on a small hand-made release."""

import pytest

from tesserae.plans.documented import Release


@pytest.fixture(scope="module")
def release(spark):
    t = {}

    def put(name, schema, rows):
        t[name] = spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in (x.split(":") for x in schema.split())))

    put("municipality_version", "lg_code:string pref:string city:string ward:string is_current:boolean", [("100", "P", "C", None, True), ("101", "P", "C", "W1", True), ("102", "P", "C", "W2", True), ("200", "P", "D", None, True), ("200", "P", "old", None, False)])
    put("census_population_municipality", "census_year:int lg_code:string population_total:long households_total:long population_change_5y:long value_status:string area_level:string", [(2025, "100", 3000, 9, 1, "ok", "1"), (2025, "101", 1000, 5, 1, "ok", "0"), (2025, "200", 0, 0, 0, "ok", None), (2020, "102", 7, 7, 7, "ok", None)])
    put("address", "address_id:string lg_code:string machiaza_id:string full_name_raw:string", [("a1", "101", "0001", "town1"), ("a2", "200", "0002", "town2")])
    bridge = "relation_type:string verification_status:string matching_rule_id:string confidence:double candidate_count:long is_current:boolean"
    put("bridge_address_postal_code", f"bridge_id:string address_id:string postal_code:string matching_rule_version:string match_run_id:string {bridge}", [("b1", "a1", "001", "1", "r1", "exact", "auto", "P2", 1.0, 1, True), ("b2", "a2", "001", "1", "r1", "ambiguous", "review_required", "P6", 0.5, 2, True), ("b3", "a2", "002", "1", "r1", "unresolved", "manually_rejected", "P9", 0.0, 0, True)])
    put("bridge_address_postal", f"address_id:string postal_record_id:string candidate_group_id:string {bridge}", [("a1", "p1", "g1", "ambiguous", "review_required", "P6", 0.5, 2, True), ("a2", "p2", "g2", "ambiguous", "review_required", "P6", 0.5, 3, True), ("a2", "p2", "g3", "exact", "auto", "P1", 1.0, 1, True)])
    put("bridge_address_mlit", f"address_id:string mlit_record_id:string {bridge}", [("a1", "m1", "exact", "auto", "M1", 1.0, 1, True)])
    put("mlit_town_version", "mlit_record_id:string mlit_code:string latitude:double longitude:double is_current:boolean", [("m1", "M001", 35.0, 139.0, True), ("m1", "M000", 0.0, 0.0, False)])
    put("postal_record_version", "postal_record_id:string old_postal_code:string postal_code:string pref:string city:string town:string town_raw:string record_kind:string is_current:boolean", [("p1", "00", "001", "P", "C", "t", "t", "town", True), ("p2", "00", "002", "P", "D", "t", "t", "town", True), ("p3", "00", "009", "P", "D", "t", "t", "town", False)])
    put("telephone_area_version", "numbering_area_code:string area_code:string area_text_raw:string is_current:boolean", [("n1", "03", "x", True), ("n2", "04", "y", True)])
    put("telephone_area_coverage", "numbering_area_code:string pref_name:string municipality_name:string qualifier:string coverage_type:string exception_text:string clause_raw:string", [("n1", "P", "C", None, "partial", "e", "c"), ("n2", "P", "D", None, "whole", None, "c")])
    put("bridge_municipality_telephone", f"lg_code:string numbering_area_code:string coverage_type:string {bridge}", [("101", "n1", "whole", "exact", "auto", "T1", 1.0, 1, True), ("101", "n2", "partial", "overlap", "auto", "T3", 0.5, 1, True), ("200", "n1", "whole", "exact", "auto", "T1", 1.0, 1, True)])
    put("match_run_input", "match_run_id:string source_snapshot_id:string role:string", [("r1", "s1", "left"), ("r1", "s2", "right")])
    put("source_snapshot", "source_snapshot_id:string provider:string dataset_name:string source_version:string downloaded_at:string sha256:string license_name:string source_page_url:string", [("s1", "v", "isj_01", "1", "2026-01-01", "ab" * 32, "l", "u"), ("s2", "v", "isj_02", "2", "2026-01-02", "cd" * 32, "l", "u"), ("s3", "v", "isj__aggregate_of_2", "2", "2026-01-02", "cd" * 32, "l", "u")])
    spatial = "lg_code:string relation_type:string verification_status:string match_method:string candidate_count:long"
    put("bridge_station_municipality", f"n02_group_code:string station_name_raw:string operator_name_raw:string {spatial}", [("s1", "S1", "O", "101", "contains", "auto", "c", 1), ("s2", "S2", "O", "101", "ambiguous", "review_required", "c", 2), ("s2", "S2", "O", "102", "ambiguous", "review_required", "c", 2), ("s3", "S3", "O", "102", "contains", "manually_rejected", "c", 1), ("s4", "S4", "O", None, "unresolved", "review_required", "u", 0)])
    put("bridge_station_line", "n02_group_code:string station_name_raw:string line_name_raw:string operator_name_raw:string", [("s1", "S1", "L", "O"), ("s1", "S1", "K", "O"), ("s2", "S2", "L", "O"), ("s3", "S3", "L", "O"), ("s4", "S4", "L", "O")])
    put("bridge_line_municipality", "line_name_raw:string operator_name_raw:string lg_code:string relation_type:string sample_hits:long municipality_count:long", [("L", "O", "101", "overlap", 5, 2), ("L", "O", "102", "overlap", 2, 2)])
    put("bridge_bus_stop_municipality", f"p11_stop_id:string stop_name_raw:string operator_name_raw:string {spatial}", [("x1", "X1", "B", "101", "contains", "auto", "c", 1), ("x2", "X2", "B", "101", "contains", "auto", "c", 1), ("x3", "X3", "B", "200", "contains", "auto", "c", 1), ("x4", "X4", "B", None, "unresolved", "review_required", "u", 0)])
    put("bridge_municipality_postal_code", "lg_code:string postal_code:string relation_type:string verification_status:string", [("101", "001", "exact", "auto"), ("101", "002", "unresolved", "review_required")])
    put("bridge_municipality_postal", "lg_code:string postal_record_id:string relation_type:string verification_status:string", [("101", "p1", "exact", "auto"), ("101", "p3", "exact", "auto")])
    put("municipality_lineage_edge", "old_lg_code:string new_lg_code:string effective_date:string event_type:string is_unique_match:boolean", [("000", "090", "2001-01-01", "rename", True), ("090", "101", "2005-01-01", "split", False), ("090", "102", "2005-01-01", "split", False), ("101", "000", "2002-01-01", "odd", True)])
    age = "census_year:int region_key:string lg_code:string area_name_raw:string area_level_raw:string nationality_raw:string sex_raw:string"
    rows = [(2025, "k", "101", "n", "0", "0_国籍総数", "0_総数", f"{c}_x", p) for c, p in (("01", 10), ("05", 60), ("14", 20), ("21", 10), ("22", 5))]
    put("census_population_age", f"{age} age_class_raw:string population:long", rows)
    put("census_population_age_summary", "census_year:int region_key:string nationality_raw:string sex_raw:string mean_age:double median_age:double", [(2025, "k", "0_国籍総数", "0_総数", 45.5, 44.0)])
    put("census_population_numbering_area", "census_year:int numbering_area_code:string municipality_count:long population_total:long households_total:long value_status:string", [(2025, "n1", 2, None, None, "member_not_whole"), (2020, "n1", 2, 1, 1, "x")])
    put("mext_school", "school_code:string school_type_code:string school_type_name:string founder_name:string school_name_raw:string address_raw:string is_active:boolean", [("c1", "B1", "primary", "f", "one", "x", True), ("c2", "B1", "primary", "f", "two", "x", True), ("c3", "C1", "middle", "f", "three", "x", False)])
    put("bridge_school_address", "school_code:string address_id:string lg_code:string relation_type:string postal_check:string verification_status:string", [("c1", "a1", "101", "located_in", "matches", "auto"), ("c2", None, "102", "municipality_only", None, "auto"), ("c3", "a1", "101", "located_in", "differs", "auto")])
    return Release(t)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_addresses_and_codes(release):
    assert rows(release.q01_postal_to_address("001")) == [("town1", "0001", "exact", "P2", 1.0, 1, "auto"), ("town2", "0002", "ambiguous", "P6", 0.5, 2, "review_required")]
    assert [r[1] for r in rows(release.q02_old_postal_to_current("00"))] == ["001", "002"]
    assert [(r[1], r[2], r[3]) for r in rows(release.q03_old_postal_to_mlit("00"))] == [("001", "town1", "M001"), ("001", "town2", None), ("002", "town2", None)]
    assert [r[:3] for r in rows(release.q04_postal_to_area_code("001"))] == [("001", "03", "n1"), ("001", "04", "n2")]
    assert {r[2:] for r in rows(release.q05_area_code_to_postal("03"))} == {("101", "whole", "T1", "001"), ("200", "whole", "T1", "001"), ("200", "whole", "T1", "002")}
    assert [r[:3] for r in rows(release.q06_mlit_to_postal("M001"))] == [("M001", "town1", "001")]
    assert [r[1] for r in rows(release.q07_ambiguous())] == ["g2", "g1"]
    assert rows(release.q08_split_municipalities()) == [("101", "P", "C", "W1", 2, "partial,whole")]
    assert [r[0] for r in rows(release.q09_partial_coverage())] == ["n1"]
    assert rows(release.q10_unmatched()) == [("address_postal_code", 1), ("bus_stop_municipality", 1), ("municipality_postal_code", 1), ("station_municipality", 1)]
    assert rows(release.q11_postal_multi_town()) == [("001", 2)]
    assert [(r[3], r[7]) for r in rows(release.q12_provenance("a1"))] == [("left", "ab" * 8), ("right", "cd" * 8)]


def test_municipalities(release):
    (r,) = release.q13_municipality_profile("101").collect()
    assert (r.stations, r.stations_ambiguous, r.lines, r.bus_stops, r.bus_stops_ambiguous, r.postal_codes, r.area_codes, r.population_total) == (1, 1, 1, 2, 0, 1, "03,04", 1000)
    (r,) = release.q13_municipality_profile("200").collect()
    assert (r.stations, r.lines, r.bus_stops, r.area_codes) == (0, 0, 1, "03")
    assert [(r[1], r[2], r[4]) for r in rows(release.q14_stations_in_municipality("100"))] == [("W1", "s1", "K"), ("W1", "s1", "L"), ("W1", "s2", "L"), ("W2", "s2", "L")]
    assert [(r[0], r[4], r[6], r[7]) for r in rows(release.q15_municipalities_on_line("L", "O"))] == [("101", 5, 1, 1000), ("102", 2, 1, None)]
    assert [(r[0], r[2]) for r in rows(release.q16_line_stations("L", "O"))] == [("s3", None), ("s4", None), ("s1", "101"), ("s2", "101"), ("s2", "102")]
    assert [(r[0], r[3], r[6]) for r in rows(release.q17_bus_stops_per_capita("P"))] == [("101", 2, 20.0), ("102", 0, None), ("200", 1, None)]
    assert [(r[1], r[5]) for r in rows(release.q18_postal_to_stations("001"))] == [("101", "s1"), ("101", "s2")]
    found = rows(release.q19_lineage_to_current("000"))
    assert [(r[0], r[2], r[6], r[7]) for r in found] == [(0, "000", False, True), (1, "090", False, True), (2, "101", True, False), (2, "102", True, False)] and found[2][1].startswith("000 →(2001-01-01 rename) 090")
    assert {r[1] for r in rows(release.current_codes_of("000"))} == {"101", "102"}


def test_census_postal_schools(release):
    assert rows(release.q20_age_structure("101")) == [("101", "n", "0_総数", 10, 60, 30, 5, 30.0, 45.5, 44.0)]
    assert rows(release.q21_aging_by_prefecture("10")) == [("101", "n", "0", 100, 30.0)]
    assert [(r[0], r[1], r[6], r[7]) for r in rows(release.q22_unresolved_stations_and_stops())] == [("station", "s2", 2, "101;102"), ("station", "s4", 1, None), ("bus_stop", "x4", 1, None)]
    assert [r[:3] for r in rows(release.q23_municipality_postal_codes("101"))] == [("P3", "001", "town"), ("P2", "001", None)]
    assert rows(release.q24_area_code_population("03")) == [("03", "x", "n1", 2, None, None, "member_not_whole")]
    assert [(r[1], r[4], r[5]) for r in rows(release.q25_source_editions())] == [("isj", 2, "1,2")]
    assert [(r[2], r[7]) for r in rows(release.q26_schools_by_postal_code("001"))] == [("c1", True), ("c3", False)]
    assert rows(release.q27_schools_in_municipality("100")) == [("B1", "primary", 2, 1, 1)]
