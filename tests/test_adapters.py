import struct

import pytest
from pyspark.sql import Row

from tesserae.errors import BuildError
from tesserae.operators import gates, points
from tesserae.plans.roundtrips import csv_payload, dbf_payload, zip_payload
from tesserae.sources import adapters


def payload(spark, *contents):
    return spark.createDataFrame([(f"f{i}", bytearray(c)) for i, c in enumerate(contents)], "path string, content binary")


def shp_points(*points):
    out = struct.pack(">i", 9994) + bytes(96)
    for i, p in enumerate(points, 1):
        body = struct.pack("<i", 0) if p is None else struct.pack("<idd", 1, *p)
        out += struct.pack(">ii", i, len(body) // 2) + body
    return out


def masters(spark, **changed):
    files = {k: zip_payload({f"{k}_2025.csv": csv_payload(c, [["1"] * len(c)], "utf-8")}) for k, c in (("pref", adapters.PREF), ("city", adapters.CITY), ("town", adapters.TOWN), ("postal", adapters.POSTAL))}
    return adapters.AddressMasters(spark, {k: payload(spark, v) for k, v in (files | changed).items() if v})


def test_masters(spark):
    whole = masters(spark)
    assert {k: len(v.columns) for k, v in whole.check().items()} == {"pref": 7, "city": 16, "town": 38, "postal": 14}
    assert whole.parse()["town"].count() == 1
    snaps = {r.resource: r for r in whole.snapshots().collect()}
    assert len(snaps) == 4 and snaps["city"].row_count == 1 and snaps["city"].schema_fingerprint == whole.check()["city"].fingerprint
    for bad in (adapters.PREF[::-1], [*adapters.PREF, "more"]):
        with pytest.raises(BuildError) as e:
            masters(spark, pref=zip_payload({"p.csv": csv_payload(bad, [["1"] * len(bad)], "utf-8")})).check()
        assert e.value.code == "SOURCE_SCHEMA_CHANGED"
    with pytest.raises(BuildError) as e:
        masters(spark, pref=None)
    assert e.value.code == "REQUIRED_SOURCE_MISSING"
    with pytest.raises(BuildError):
        adapters.AddressMasters(spark, {"other": "x"})


def test_changes(spark):
    def row(code, reason):
        return ["1", "", "", code, "北海道", "", "", "札幌市", "さっぽろし", "2020-04-01", reason, "", ""]

    new, old, kept = row("01003", "新設"), row("01002", "新設"), row("01001", "新設")
    files = {"changes": [new, old, kept, row("", "新設")], "changes_created": [new], "changes_abolished": [old]}
    made = lambda f: {k: payload(spark, csv_payload(adapters.CHANGES, v, "utf-8-sig")) for k, v in f.items()}
    tables = adapters.MunicipalityChanges(spark, made(files)).parse()
    assert sorted((r["標準地域コード"] or "", r.is_created, r.is_abolished, r.parse_status) for r in tables["municipality_change"].collect()) == [
        ("", False, False, "incomplete"), ("01001", False, False, "parsed"), ("01002", False, True, "parsed"), ("01003", True, False, "parsed")]
    assert [(r.old, r.new, r.is_unique) for r in tables["lineage_edge"].collect()] == [("01002", "01003", True)]
    assert adapters.MunicipalityChanges(spark, {}).parse() == {} and adapters.MunicipalityChanges(spark, {}).snapshots().isEmpty()
    with pytest.raises(BuildError) as e:
        adapters.MunicipalityChanges(spark, made({"changes": [new]}))
    assert e.value.code == "SOURCE_FETCH_FAILED"
    with pytest.raises(BuildError) as e:
        adapters.MunicipalityChanges(spark, made(files | {"changes_created": [row("09999", "新設")]})).parse()
    assert e.value.code == "SOURCE_SCHEMA_CHANGED"


def test_change_edges_without_created(spark):
    rows = spark.createDataFrame([("a", "d", "r", 1), ("b", "d", "r", 2), ("c", "d", "s", 1), ("b", "d", "r", 2), (None, "d", "r", 1)], "code string, date string, reason string, kind int")
    marked = points.municipality_changes(rows, rows.filter("kind = 0"), rows.filter("kind = 1"), "code", "date", "reason")
    assert marked.count() == 5
    assert sorted((r.old, r.new) for r in points.change_edges(marked, "code", "date", "reason").collect()) == [("a", "b"), ("c", None)]


def test_boundaries_and_schools(spark):
    area = dbf_payload(adapters.BOUNDARY, [["01", "102"] * 14 + ["x"]], "cp932")
    found = adapters.Boundaries(spark, {"areas": payload(spark, zip_payload({"a.dbf": area}), zip_payload({"b.dbf": area}))})
    assert len(found.check()["areas"].columns) == 29
    assert [r.municipality_code for r in found.parse()["areas"].collect()] == ["10201"] * 2
    rows = [["01", "S1", "3", "学校", "", "", "1", "00", ""], ["01", "S1", "3", "学校", "", "", "1", "01", ""]]

    def schools(rows, *shapes):
        return adapters.SchoolPoints(spark, {"schools": payload(spark, zip_payload({"x/P29-23.dbf": dbf_payload(adapters.SCHOOLS, rows, "utf-8"), "x/P29-23.shp": shp_points(*shapes)}))}).parse()["schools"]

    assert [(r.P29_008, r.x) for r in schools(rows, (139.5, 35.5), None).orderBy("P29_008").collect()] == [("00", 139.5), ("01", None)]
    with pytest.raises(Exception, match="SOURCE_SCHEMA_CHANGED"):
        schools(rows, (139.5, 35.5)).collect()
    with pytest.raises(BuildError) as e:
        schools([rows[0], rows[0]], None, None)
    assert e.value.code == "DUPLICATE_KEY_ANOMALY"
    other = zip_payload({"b.dbf": dbf_payload(adapters.BOUNDARY[:-1], [["1"] * 28], "cp932")})
    with pytest.raises(BuildError):
        adapters.Boundaries(spark, {"areas": payload(spark, zip_payload({"a.dbf": area}), other)}).check()


def test_measures_without_rows(spark):
    none = spark.createDataFrame([], "relation_type string, verification_status string, candidate_count long, confidence double")
    m = gates.bridge_measures(none, "b").first()
    assert m.n_rows == 0 and m.candidate_count == 0 and m.exact_pct is None
    assert gates.bridge_distributions(none).isEmpty()
    s = gates.source_measures(none, "s", ["relation_type"]).first()
    assert s.n_rows == 0 and s.n_duplicates == 0
    rows = spark.createDataFrame([Row(k=None, v=1), Row(k=None, v=None), Row(k="a", v=2)], "k string, v int")
    s = gates.source_measures(rows, "s", ["k"]).first()
    assert (s.n_rows, s.n_keys, s.n_duplicates, s.nulls) == (3, 2, 1, {"k": 2, "v": 1})


def test_release_gates(spark):
    measures = spark.createDataFrame([("exact_fall", "b", 3.0), ("exact_fall", "c", 3.1), ("exact_rise", "b", 6.0), ("exact_rise", "c", None), ("duplicate_keys", "s", 1.0)], "metric string, subject string, value double")
    approved = spark.createDataFrame([("b", "exact_rise", "1", "2", 6.0, 0.5), ("c", "exact_fall", "0", "1", 3.1, 0.5)], "subject string, metric string, old_version string, new_version string, expected double, tolerance double")
    versions = spark.createDataFrame([("b", "1", "2"), ("c", "1", "2")], "subject string, old_version string, new_version string")
    found = {(r.metric, r.subject): r.verdict for r in gates.release_gates(measures, approved, versions).collect()}
    assert found == {("exact_fall", "b"): "warn", ("exact_fall", "c"): "fail", ("exact_rise", "b"): "approved", ("exact_rise", "c"): "unknown", ("duplicate_keys", "s"): "fail"}
    with pytest.raises(Exception, match="VALIDATION_FAILED"):
        gates.release_gates(measures.withColumn("metric", gates.F.lit("other")), approved, versions).collect()


def record(code, town, old="060  "):
    return ["01101", old, code, "k", "k", "k", "北海道", "札幌市中央区", town, "0", "0", "0", "0", "0", "0"]


def test_postal_records_and_deltas(spark):
    whole = [record("0640941", "旭ケ丘"), record("0600000", "以下に掲載がない場合"), record("0600042", "大通西（１～１９丁目）", "00601"), record("0600042", "大通西（１～１９丁目）", "00601")]
    added, gone = [record("0600099", "新町"), record("1000000", "島一円")], [whole[3]]
    made = lambda rows, name: payload(spark, zip_payload({name: csv_payload(None, rows, "utf-8-sig")}))
    source = adapters.PostalRecords(spark, {"ken_all": made(whole, "utf_ken_all.csv"), "delta_add": made(added, "utf_add_2607.csv"), "delta_del": made(gone, "utf_del_2607.csv")})
    assert set(source.check()) == {"ken_all", "delta_add", "delta_del"}
    tables = source.parse()
    assert sorted((r.postal_code, r.old_postal_code, r.record_kind) for r in tables["ken_all"].collect()) == [
        ("0600000", "060", "no_listing"), ("0600042", "00601", "town"), ("0600042", "00601", "town"), ("0640941", "060", "town")]
    after = adapters.rolled_forward(tables["ken_all"], tables["delta"])
    assert sorted(r.postal_code for r in after.collect()) == ["0600000", "0600042", "0600099", "0640941", "1000000"]
    again = adapters.rolled_forward(after, tables["delta"])  # takes out the second of the two
    assert again.filter("postal_code = '0600042'").isEmpty()
    with pytest.raises(Exception, match="VALIDATION_FAILED"):
        adapters.rolled_forward(again, tables["delta"]).collect()
    alone = adapters.PostalRecords(spark, {"ken_all": made(whole, "utf_ken_all.csv")})
    assert set(alone.parse()) == {"ken_all"}
    with pytest.raises(BuildError) as e:
        adapters.PostalRecords(spark, {"delta_add": made(added, "a.csv")})
    assert e.value.code == "REQUIRED_SOURCE_MISSING"


def test_town_points_and_school_codes(spark):
    towns = [["01", "北海道", "01101", "札幌市中央区", "011010001001", "旭ケ丘一丁目", "43.04223", "141.319722", "1", "3"], ["01", "北海道", "01101", "札幌市中央区", "011010002000", "円山", "", "x", "1", "1"]]
    files = [zip_payload({f"0{i}_2025.csv": csv_payload(adapters.TOWN_POINTS, towns[i : i + 1], "cp932")}) for i in (0, 1)]
    found = adapters.TownPoints(spark, {"towns": payload(spark, *files)})
    assert len(found.check()["towns"].columns) == 10
    assert sorted((r.mlit_code, r.latitude, r.longitude) for r in found.parse()["towns"].collect()) == [("011010001001", 43.04223, 141.319722), ("011010002000", None, None)]
    school = lambda code, to="", end="": [code, "B1", "01", "2", "1", "学校", "札幌市", "0600000", "2020-04-01", end, "", to]
    made = lambda **rows: {k: payload(spark, csv_payload(adapters.SCHOOL_CODES, v, "cp932")) for k, v in rows.items()}
    tables = adapters.SchoolCodes(spark, made(east=[school("A1", "B2; C9", "2024-03-31")], west=[school("B2")], university=[])).parse()
    assert sorted((r.school_code, r.resource, r.is_active) for r in tables["school"].collect()) == [("A1", "east", False), ("B2", "west", True)]
    assert sorted(map(tuple, tables["school_succession"].collect())) == [("A1", "B2", True), ("A1", "C9", False)]
    assert adapters.SchoolCodes(spark, {}).parse() == {}
    with pytest.raises(BuildError) as e:
        adapters.SchoolCodes(spark, made(east=[], west=[]))
    assert e.value.code == "SOURCE_FETCH_FAILED"
    with pytest.raises(BuildError) as e:
        adapters.SchoolCodes(spark, made(east=[school("A1")], west=[school("A1")], university=[])).parse()
    assert e.value.code == "DUPLICATE_KEY_ANOMALY"


def test_bus_stops(spark):
    def stop(name, *operators):
        return [name, "会社", *[o for o, _ in operators], *[""] * (35 - len(operators)), *[r for _, r in operators], *[""] * (35 - len(operators)), ""]

    def zipped(rows, *shapes):
        inner = zip_payload({"P11-22_01.dbf": dbf_payload(adapters.BUS_STOPS, rows, "cp932"), "P11-22_01.shp": shp_points(*shapes)})
        return {"stops": payload(spark, zip_payload({"P11-22_01_GML.zip": inner}))}

    rows = [stop("駅前", ("甲バス", "1,2"), ("乙バス", "3")), stop("役場")]
    source = adapters.BusStops(spark, zipped(rows, (141.3, 43.0), None))
    assert len(source.check()["stops"].columns) == 73
    tables = source.parse()
    stops = {r.stop_name_raw: r for r in tables["stops"].collect()}
    assert (stops["駅前"].x, stops["駅前"].y, stops["役場"].x) == (141.3, 43.0, None) and len({r.p11_stop_id for r in stops.values()}) == 2
    assert sorted((r.place, r.operator, r.routes) for r in tables["stop_operators"].collect()) == [(1, "甲バス", "1,2"), (2, "乙バス", "3")]
    with pytest.raises(Exception, match="SOURCE_SCHEMA_CHANGED"):
        adapters.BusStops(spark, zipped(rows, (141.3, 43.0))).parse()["stops"].collect()
