import gzip
import io
import sqlite3
import struct
import zipfile

import pytest

from tesserae.errors import CODES, BuildError
from tesserae.sources import archives, binary, readers, sinks


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


@pytest.mark.parametrize("name", ["../a.csv", "/a.csv", "C:/a.csv", "a/../../b.csv"])
def test_paths_stay_inside(name):
    with pytest.raises(BuildError) as e:
        list(archives.read_members(zipped({name: b"x"})))
    assert e.value.code == "UNSAFE_ARCHIVE"


def test_archives_are_bounded():
    with pytest.raises(BuildError):
        list(archives.read_members(zipped({"a": b"0" * 5_000_000}), limits=archives.Limits(ratio=10)))
    with pytest.raises(BuildError):
        list(archives.read_members(zipped({f"f{i}": b"x" for i in range(30)}), limits=archives.Limits(members=10)))
    with pytest.raises(BuildError):
        archives.check_magic("zip", b"<!doctype html>")
    nested = zipped({"in.zip": zipped({"a.csv": b"1"}), "b.csv": b"2"})
    assert dict(archives.read_members(nested, ".csv")) == {"in.zip/a.csv": b"1", "b.csv": b"2"}


def test_drift():
    base = archives.SchemaInfo(("a", "b"), "utf-8", "zip", ("x/01_2025.csv",))
    archives.check_drift("r", archives.SchemaInfo(("a", "b"), "utf-8", "zip", ("x/01_2026.csv",)), base)
    for other in (("a", "b", "c"), ("b", "a")):
        with pytest.raises(BuildError):
            archives.check_drift("r", archives.SchemaInfo(other, "utf-8", "zip", base.members), base)
    for change in ({"encoding": "cp932"}, {"notes": ("n",)}):
        with pytest.raises(BuildError):
            archives.check_drift("r", archives.SchemaInfo(**({"columns": base.columns, "encoding": "utf-8", "container": "zip", "members": base.members} | change)), base)
    assert archives.change_signature({"b": "2", "a": "1"}) == "a\t1\nb\t2" and archives.fallbacks({"a": "discovery", "b": "pinned"}) == ["b"]
    assert len(CODES) == 13 and "k=1" in str(BuildError("SOURCE_FETCH_FAILED", "m", k=1))


def dbf(names, rows, encoding="cp932"):
    width = 10
    head = 32 + 32 * len(names) + 1
    out = struct.pack("<B3xIHH20x", 3, len(rows), head, 1 + width * len(names))
    for n in names:
        out += n.encode(encoding).ljust(11, b"\0") + b"C" + bytes(4) + bytes([width]) + bytes(15)
    out += b"\r"
    for r in rows:
        out += b" " + b"".join(v.encode(encoding).ljust(width) for v in r)
    return out


def shp(*bodies):
    out = struct.pack(">i", 9994) + bytes(96)
    for i, b in enumerate(bodies, 1):
        out += struct.pack(">ii", i, len(b) // 2) + b
    return out


def point(x, y):
    return struct.pack("<idd", 1, x, y)


def test_dbf_and_shapes(spark, tmp_path):
    table = dbf(["KEY", "NAME"], [["01 ", "東京"], ["02", ""]])
    line = struct.pack("<i4d2i2i", 3, 0, 0, 2, 2, 2, 4, 0, 2) + struct.pack("<8d", 0, 0, 1, 1, 1, 1, 2, 2)
    shapes = shp(point(139.766103, 35.681247), struct.pack("<i", 0), line)
    (tmp_path / "a.zip").write_bytes(zipped({"x.dbf": table, "x.shp": shapes}))
    rows = readers.dbf(spark, str(tmp_path / "a.zip"), ["NAME", "KEY"]).orderBy("row_ordinal").collect()
    assert [(r.row_ordinal, r.NAME, r.KEY) for r in rows] == [(0, "東京", "01"), (1, None, "02")]
    found = readers.shapes(spark, str(tmp_path / "a.zip")).orderBy("row_ordinal").collect()
    assert found[0].parts == [[(139.766103, 35.681247)]] and found[1].parts is None and found[1].x0 is None
    assert found[2].parts == [[(0, 0), (1, 1)], [(1, 1), (2, 2)]]
    for bad in (b"x" * 200, shapes[:-8]):
        with pytest.raises(BuildError):
            binary.read_shp(bad)
    with pytest.raises(BuildError):
        binary.read_shp(shapes, expect=binary.POLYGON)
    assert binary.read_shp(shp(struct.pack("<i", 0)), expect=binary.POINT) == [None]
    with pytest.raises(BuildError):
        binary.read_dbf(table[:-5])


def test_csv_in_zip(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped({"a.csv": "01,東京  \n02,\"a,b\"\n".encode("cp932")}))
    out = readers.zip_csv(spark, str(tmp_path / "a.zip"), ["code", "name"], "cp932", header=False)
    assert [(r.row_ordinal, r.code, r.name) for r in out.orderBy("row_ordinal").collect()] == [(0, "01", "東京  "), (1, "02", "a,b")]
    (tmp_path / "b.csv").write_bytes("\ufeffx,y\n1,2\n".encode())
    assert readers.plain_csv(spark, str(tmp_path / "b.csv"), ["x", "y"]).count() == 1
    for columns in (["y", "x"], ["x"]):
        with pytest.raises(Exception, match="SOURCE_SCHEMA_CHANGED"):
            readers.plain_csv(spark, str(tmp_path / "b.csv"), columns).count()
    snaps = readers.snapshots(spark, str(tmp_path / "a.zip"), "s", out).collect()
    assert snaps[0].row_count == 2 and snaps[0].source == "s" and len(snaps[0].sha256) == 64
    with pytest.raises(BuildError):
        readers.tagged_union({"east": out}, ["east", "west"], "part")
    assert {r.part for r in readers.tagged_union({"east": out, "west": out}, ["east", "west"], "part").collect()} == {"east", "west"}
    assert readers.previous_release(spark, str(tmp_path), "none") is None
    assert {(r.column, r.filled, r.of) for r in readers.fill_rates(out.select("member", "code", "name"), "member").collect()} == {("code", 2, 2), ("name", 2, 2)}


def word_streams(pieces, main=None):
    word, plc_ends, descriptors = bytearray(0x400), [0], b""
    for text, narrow in pieces:
        at = len(word)
        word += text.encode("cp1252" if narrow else "utf-16-le")
        descriptors += struct.pack("<HIH", 0, (at * 2) | 0x40000000 if narrow else at, 0)
        plc_ends.append(plc_ends[-1] + len(text))
    plc = struct.pack(f"<{len(plc_ends)}i", *plc_ends) + descriptors
    table = b"\x01" + struct.pack("<H", 2) + b"zz" + b"\x02" + struct.pack("<I", len(plc)) + plc
    struct.pack_into("<i", word, 0x4C, plc_ends[-1] if main is None else main)
    struct.pack_into("<iI", word, 0x1A2, 0, len(table))
    return bytes(word), table


def compound(streams):
    """A compound file with ordinary sectors only: FAT, directory, streams."""
    sector, sectors, fat, entries = 512, [], [], []
    streams = {k: v.ljust(4096, b"\0") for k, v in streams.items()}
    place = 2
    for name, data in streams.items():
        n = -(-len(data) // sector)
        entries.append((name, 2, place, len(data)))
        sectors.append(data.ljust(n * sector, b"\0"))
        fat += [*range(place + 1, place + n), 0xFFFFFFFE]
        place += n
    directory = b""
    for name, kind, begin, size in [("Root Entry", 5, 0xFFFFFFFE, 0), *entries]:
        raw = name.encode("utf-16-le") + b"\0\0"
        directory += raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw), kind, 1) + struct.pack("<III", *[0xFFFFFFFF] * 3) + bytes(36) + struct.pack("<IQ", begin, size)
    assert len(directory) <= sector and len(fat) + 2 <= 128
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<IIIIIIIIII", 0, 1, 1, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0, 0) + struct.pack("<108I", *[0xFFFFFFFF] * 108)
    table = struct.pack("<128I", *[0xFFFFFFFD, 0xFFFFFFFE, *fat, *[0xFFFFFFFF] * (126 - len(fat))])
    return head + table + directory.ljust(sector, b"\0") + b"".join(sectors)


def test_word_tables(spark, tmp_path):
    text = "title\r11\x07札幌\x07011\x07\x07" + "12\x07小樽\x070134\x07\x07" + "end"
    streams = word_streams([(text[:10], False), (text[10:], False), ("café", True)], len(text))
    assert binary.piece_text(*streams) == text
    content = compound({"WordDocument": streams[0], "1Table": streams[1]})
    assert binary.read_doc(content) == text
    (tmp_path / "a.doc").write_bytes(content)
    rows = readers.word_table(spark, str(tmp_path / "a.doc"), ["code", "area", "number"]).orderBy("row_ordinal").collect()
    assert [(r.code, r.area, r.number) for r in rows] == [("11", "札幌", "011"), ("12", "小樽", "0134")]
    for word, table in ((streams[0], b"\x03" + streams[1][1:]), (streams[0][:-20], streams[1]), word_streams([("ab", True)], 9), word_streams([])):
        with pytest.raises(BuildError):
            binary.piece_text(word, table)
    for text, told in (("a\x07b\x07c\x07\x07x\x07y\x07\x07d\x07e\x07f\x07\x07", "another shape inside"), ("x\x07y\x07\x07", "no row has"), ("plain", "no row has")):
        with pytest.raises(Exception, match=told):
            readers.table_rows(spark.createDataFrame([("f", text)], "source_file string, text string"), ["a", "b", "c"]).collect()
    around = readers.table_rows(spark.createDataFrame([("f", "p\x07q\x07\x07title\r a \x07b\x07c\0\x07\x07d\x07\x07f\x07\x07")], "source_file string, text string"), ["a", "b", "c"])
    assert [tuple(r)[2:] for r in around.collect()] == [(0, "a", "b", "c")]
    with pytest.raises(BuildError):
        binary.read_doc(b"<html>" * 200)


def test_xlsx(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {ns}><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2"><v>5</v></c></row><row r="3"><c r="A3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>'
    book = zipped({"xl/sharedStrings.xml": f"<sst {ns}><si><t>札</t><t>幌</t><rPh><t>サッポロ</t></rPh></si></sst>", "xl/worksheets/sheet1.xml": sheet})
    assert binary.read_xlsx(book) == [[], ["札幌", None, "5"], ["x"]]
    (tmp_path / "a.xlsx").write_bytes(book)
    assert [(r.a, r.b, r.c) for r in readers.xlsx_table(spark, str(tmp_path / "a.xlsx"), ["a", "b", "c"], 2).orderBy("row_ordinal").collect()] == [("札幌", None, "5"), ("x", None, None)]


def test_sheets_are_read_whole_or_not_at_all():
    whole = readers._sheet_rows([["a", "b"], ["c"], [], [None, None]], 3, False)
    assert whole == [["a", "b", None], ["c", None, None]] and readers._sheet_rows([], 3, False) == []
    for cells, notes in (([["a"], [], ["c"]], False), ([["a", "b", "c", "d"]], False), ([["a", "b"], [], ["c", "d"]], True)):
        with pytest.raises(BuildError, match="SOURCE_SCHEMA_CHANGED"):
            readers._sheet_rows(cells, 3, notes)
    assert readers._sheet_rows([["a", "b"], ["c", "d"], [], ["1) a footnote"]], 2, True) == [["a", "b"], ["c", "d"]]


def test_archives_too_deep():
    inner = zipped({"a.csv": b"1"})
    assert dict(archives.read_members(zipped({"in.zip": zipped({"in.zip": inner})}), ".csv", depth=3))
    with pytest.raises(BuildError, match="UNSAFE_ARCHIVE"):
        list(archives.read_members(zipped({"in.zip": zipped({"in.zip": inner})}), ".csv"))


def test_maps_land_and_keys(spark):
    df = spark.createDataFrame([("A1", "8101", None, "01", "101"), ("B1", "8154", None, "01", None), ("A1", "8101", "D1", "x", "y"), ("A1", "8101", "D", "x", "z")], "k string, hcode string, kigo_d string, p string, c string")
    assert [r.v for r in readers.mapped(df.filter("k = 'A1'"), "k", {"A1": "school"}, "v").collect()] == ["school"] * 3
    with pytest.raises(Exception, match="unknown value"):
        readers.mapped(df, "k", {"A1": "school"}, "v").collect()
    assert [r.kigo_d for r in readers.land(df).collect()] == [None, "D"]
    assert [r.j for r in df.select(readers.joined_key("p", "c").alias("j")).collect()] == ["01101", None, "xy", "xz"]


def test_sqlite_types_and_references(spark, tmp_path):
    import datetime
    import decimal

    df = spark.createDataFrame([("k", datetime.date(2026, 1, 2), datetime.datetime(2026, 1, 2, 3, 4, 5), decimal.Decimal("1.50"), [1, 2])], "k string, d date, t timestamp_ntz, n decimal(6,2), a array<int>")
    child = spark.createDataFrame([(1, "k"), (2, None)], "i int, k string")
    sinks.write_sqlite_gz({"p": df, "c": child}, str(tmp_path / "s"), {"p": ["k"], "c": ["i"]}, foreign={"c": [("k", "p", "k")]})
    con = sqlite3.connect(":memory:")
    con.deserialize(gzip.decompress((tmp_path / "s").read_bytes()))
    assert con.execute("select * from p").fetchall() == [("k", "2026-01-02", "2026-01-02 03:04:05", "1.50", "[1,2]")]
    with pytest.raises(BuildError, match="VALIDATION_FAILED"):
        sinks.write_sqlite_gz({"p": df, "c": child.unionByName(spark.createDataFrame([(3, "lost")], "i int, k string"))}, str(tmp_path / "s"), {"p": ["k"], "c": ["i"]}, foreign={"c": [("k", "p", "k")]})
    sinks.write_tables_zip({"p": df.drop("a"), "c": child}, str(tmp_path / "z.zip"), {"p": ["k"], "c": ["i"]})
    assert zipfile.ZipFile(tmp_path / "z.zip").namelist() == ["c.parquet", "p.parquet"]


def biff(sheet, strings, cells):
    record = lambda kind, data: struct.pack("<HH", kind, len(data)) + data
    body = b"".join(struct.pack("<HB", len(t), 1) + t.encode("utf-16-le") for t in strings)
    head = record(0x0809, b"\0\x06\x05\0" + bytes(12))
    name = bytes([len(sheet), 1]) + sheet.encode("utf-16-le")
    cut = 3 + 2  # the first string goes on in a CONTINUE record
    sst = record(0x00FC, struct.pack("<II", len(strings), len(strings)) + body[:cut]) + record(0x003C, b"\x01" + body[cut:])
    place = len(head) + 4 + 6 + len(name) + len(sst) + 4
    book = head + record(0x0085, struct.pack("<IH", place, 0) + name) + sst + record(0x000A, b"")
    assert len(book) == place
    return book + head + b"".join(record(k, d) for k, d in cells) + record(0x000A, b"")


def test_xls(spark, tmp_path):
    cells = [(0x00FD, struct.pack("<HHHI", 1, 0, 0, 0)), (0x0203, struct.pack("<HHHd", 1, 2, 0, 2.5)), (0x027E, struct.pack("<HHHI", 2, 0, 0, 7 << 2 | 2)), (0x00BD, struct.pack("<HHHIHIH", 2, 1, 0, 150 << 2 | 3, 0, 4 << 2 | 2, 2)), (0x00FD, struct.pack("<HHHI", 1, 1, 0, 1))]
    stream = biff("公開データ", ["札幌市", "011"], cells)
    assert binary.biff_rows(stream, "公開データ") == [[], ["札幌市", "011", "2.5"], ["7", "1.5", "4"]]
    with pytest.raises(BuildError):
        binary.biff_rows(stream, "other")
    (tmp_path / "a.xls").write_bytes(compound({"Workbook": stream}))
    assert [(r.a, r.b, r.c) for r in readers.xls_table(spark, str(tmp_path / "a.xls"), ["a", "b", "c"], 2, "公開データ").orderBy("row_ordinal").collect()] == [("札幌市", "011", "2.5"), ("7", "1.5", "4")]


def test_shape_container():
    good = {"a.cpg": b"UTF-8", "a.prj": b"GEOGCS[JGD_2011]"}
    archives.check_shape_container(zipped(good))
    for bad in ({"a.cpg": b"UTF-8"}, good | {"b.cpg": b"UTF-8"}, good | {"a.cpg": b"cp932"}, good | {"a.prj": b"WGS84"}):
        with pytest.raises(BuildError):
            archives.check_shape_container(zipped(bad))


def test_outputs_are_reproducible(spark, tmp_path):
    a = spark.createDataFrame([("02", 2, True, 0.5), ("01", 1, False, None)], "k string, n long, b boolean, d double")
    b = a.orderBy("n").repartition(3)
    for write, name in ((sinks.write_parquet_file, "p"), (sinks.write_csv_gz, "c"), (sinks.write_csv, "r")):
        write(a, str(tmp_path / f"{name}1"), ["k"])
        write(b, str(tmp_path / f"{name}2"), ["k"])
        assert (tmp_path / f"{name}1").read_bytes() == (tmp_path / f"{name}2").read_bytes()
    assert gzip.decompress((tmp_path / "c1").read_bytes()).decode() == "k,n,b,d\n01,1,False,\n02,2,True,0.5\n"
    (tmp_path / "ledger.csv.gz").write_bytes((tmp_path / "c1").read_bytes())
    assert [r.k for r in readers.ledger(spark, str(tmp_path / "ledger.csv.gz"), ["k", "n", "b", "d"]).collect()] == ["01", "02"]
    sinks.write_sqlite_gz({"t": a}, str(tmp_path / "s1"), {"t": ["k"]}, {"t": ["n > 0"]})
    sinks.write_sqlite_gz({"t": b}, str(tmp_path / "s2"), {"t": ["k"]}, {"t": ["n > 0"]})
    assert (tmp_path / "s1").read_bytes() == (tmp_path / "s2").read_bytes()
    con = sqlite3.connect(":memory:")
    con.deserialize(gzip.decompress((tmp_path / "s1").read_bytes()))
    assert con.execute("select k, b from t").fetchall() == [("01", 0), ("02", 1)]
    with pytest.raises(BuildError):
        sinks.write_sqlite_gz({"t": a}, str(tmp_path / "s3"), {"t": ["k"]}, {"t": ["n > 1"]})
    sinks.write_points({"station_point": a}, str(tmp_path / "z"), {"station_point": ["k"]})
    assert zipfile.ZipFile(tmp_path / "z").namelist() == ["station_point.parquet"]
    sinks.write_points({"station_point": a.limit(0)}, str(tmp_path / "z"), {"station_point": ["k"]})
    assert not (tmp_path / "z").exists()
    sinks.write_diff({"b": 1, "a": 2}, str(tmp_path))
    assert (tmp_path / "diff.md").read_text().index("| a | 2 |") < (tmp_path / "diff.md").read_text().index("| b | 1 |")
    with pytest.raises(BuildError):
        sinks._rows(a, ["k"], most=1)


def test_stop_chunks(spark):
    df = spark.createDataFrame([("m", "駅\"前", "B", 1.5, 2.0), ("m", "駅\"前", "A", 1.5, 2.0), ("m", "a", "A", 0.0, 0.25)], "mesh string, name string, operator string, x double, y double")
    import json

    (row,) = sinks.bus_chunks(df).collect()
    assert json.loads(row.chunk) == [["a", ["A"], 0.0, 0.25], ['駅"前', ["A", "B"], 1.5, 2.0]]
