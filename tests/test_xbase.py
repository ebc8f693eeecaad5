"""xBase files: bytes in, typed rows out."""

import struct
from datetime import date, datetime
from decimal import Decimal

import pytest

from ledgerspark.jobs.discover import discover
from ledgerspark.plans import profile
from ledgerspark.sources import files, xbase
from tests.dbf_files import dbf, write

FIELDS = [("CODE", "C", 6, 0), ("AMT", "N", 9, 2), ("RATE", "F", 8, 3), ("DAY", "D", 8, 0), ("OK", "L", 1, 0)]
RECORDS = [
    (" ", "a1", "12.50", "1.250", "20250131", "T"),
    ("*", "gone", "1.00", "1.000", "20250101", "T"),
    (" ", b"\x80\xe9\x00x", "", "", "20251301", "?"),
    (" ", "", "abc", "2", "        ", " "),
]
ROWS = [
    ("a1", Decimal("12.50"), Decimal("1.250"), date(2025, 1, 31), True),
    ("€éx", None, None, None, None),
    (None, None, Decimal("2.000"), None, None),
]


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("_source_path", "_seq").select(*columns).collect()]


def test_reads_live_typed_records(spark, tmp_path):
    df = xbase.read_xbase(spark, [write(tmp_path / "T.DBF", FIELDS, RECORDS)])
    assert dict(df.dtypes)["amt"] == "decimal(18,2)" and dict(df.dtypes)["rate"] == "decimal(18,3)"
    assert rows(df, "code", "amt", "rate", "day", "ok") == ROWS
    assert rows(df, "_seq") == [(0,), (2,), (3,)]


def test_splitting_a_file_changes_nothing(spark, tmp_path):
    many = [(" ", f"c{i}", str(i), "", "20250131", "T") for i in range(500)]
    path = write(tmp_path / "T.DBF", FIELDS, many)
    whole, split = xbase.read_xbase(spark, [path]), xbase.read_xbase(spark, [path], split_bytes=1000)
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 10
    assert rows(whole, "_seq", "code", "amt") == rows(split, "_seq", "code", "amt")
    assert split.count() == 500


def test_short_last_record_ends_the_scan(spark, tmp_path):
    path = write(tmp_path / "T.DBF", FIELDS, RECORDS[:1], tail=b" half")
    assert rows(xbase.read_xbase(spark, [path]), "code") == [("a1",)]


@pytest.mark.parametrize("split", [20, 100, 10**6])
def test_the_end_mark_ends_the_scan(spark, tmp_path, split):
    many = [(" ", f"c{i}", str(i), "", "20250131", "T") for i in range(40)]
    left_over = b"\x1a" + dbf(FIELDS, many)[-200:]
    path = write(tmp_path / "T.DBF", FIELDS, many, tail=left_over)
    assert rows(xbase.read_xbase(spark, [path], split_bytes=split), "code") == [(f"c{i}",) for i in range(40)]
    blob = (tmp_path / "T.DBF").read_bytes()
    for count in (0, 7, 1000):  # a header that counts wrong
        (tmp_path / "T.DBF").write_bytes(blob[:4] + struct.pack("<I", count) + blob[8:])
        assert xbase.read_xbase(spark, [path], split_bytes=split).count() == 40


def test_only_a_blank_flag_is_live(spark, tmp_path):
    path = write(tmp_path / "T.DBF", [("A", "C", 1, 0)], [(" ", "a"), ("*", "b"), ("x", "c"), ("\0", "d"), (" ", "e")])
    assert rows(xbase.read_xbase(spark, [path]), "a") == [("a",), ("e",)]


def test_doubles_and_comma_decimals(spark, tmp_path):
    values = [0.0, -0.0, 1.5, -2.75, 1e300, 5e-324, 2.2250738585072014e-308, -1.7976931348623157e308, 0.1, 123456789.123]
    records = [(" ", struct.pack("<d", v), "1,5") for v in [*values, float("inf"), float("nan")]]
    got = rows(xbase.read_xbase(spark, [write(tmp_path / "T.DBF", [("D", "B", 8, 0), ("N", "N", 5, 2)], records)]), "d", "n")
    assert [r[0] for r in got] == [*values, None, None]
    assert {r[1] for r in got} == {Decimal("1.50")}


def test_layouts_that_differ_are_united_by_name(spark, tmp_path):
    a = write(tmp_path / "A" / "T.DBF", FIELDS, RECORDS[:1])
    b = write(tmp_path / "B" / "T.DBF", [("AMT", "N", 12, 3), ("NEW", "C", 4, 0)], [(" ", "7.125", "n")])
    got = rows(xbase.read_xbase(spark, [a, b]), "code", "amt", "new")
    assert got == [("a1", Decimal("12.500"), None), (None, Decimal("7.125"), "n")]


def test_header_names_and_types():
    blob = dbf([(b"INVNO\0EbG", "N", 8, 0), ("1ST", "C", 2, 0), ("ODD", b"@", 3, 0), (b"\0", "C", 5, 0), ("LAST", "C", 1, 0)], [])
    header = xbase.parse_header(blob)
    assert [(f.column, f.code, f.offset) for f in header.fields] == [("invnoebg", "N", 1), ("f_1st", "C", 9), ("odd", "C", 11), ("last", "C", 19)]
    assert xbase.parse_header(b"short").fields == ()
    assert header.records_in(10) == 0


def test_colliding_names_and_empty_headers_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="collide"):
        xbase.read_xbase(spark, [write(tmp_path / "T.DBF", [("A-B", "C", 1, 0), ("A_B", "C", 1, 0)], [])])
    (tmp_path / "E.DBF").write_bytes(b"tiny")
    with pytest.raises(ValueError, match="no fields"):
        xbase.read_xbase(spark, [str(tmp_path / "E.DBF")])


def test_numbers_stored_as_bytes(spark, tmp_path):
    fields = [("N", "I", 4, 0), ("AUTO", "+", 4, 0), ("PRICE", "Y", 8, 4), ("AT", "T", 8, 0), ("TEXT", "I", 6, 0)]
    julian = 2440588 + (date(2025, 1, 31) - date(1970, 1, 1)).days
    records = [
        (" ", struct.pack("<i", -7), struct.pack("<i", 9), struct.pack("<q", -123456), struct.pack("<II", julian, 45_296_250), "  12"),
        (" ", struct.pack("<i", 2**31 - 1), struct.pack("<i", 0), struct.pack("<q", 2**62), struct.pack("<II", 0, 0), "x"),
    ]
    got = rows(xbase.read_xbase(spark, [write(tmp_path / "T.DBF", fields, records)]), "n", "auto", "price", "at", "text")
    assert got == [
        (-7, 9, Decimal("-12.3456"), datetime(2025, 1, 31, 12, 34, 56, 250000), 12),
        (2**31 - 1, 0, Decimal(2**62) / 10000, None, None),
    ]


def test_no_records(spark, tmp_path):
    assert xbase.read_xbase(spark, [write(tmp_path / "T.DBF", FIELDS, [])]).count() == 0


def test_listing(spark, tmp_path):
    for name in ("A/SALES1.DBF", "A/sales1.dbf", "A/TEMP.DBF", "A/notes.txt", "B/Item.DBF"):
        write(tmp_path / name, FIELDS, RECORDS)
    folders = {"A": str(tmp_path / "A"), "B": str(tmp_path / "B"), "C": str(tmp_path / "missing")}
    found = files.list_sources(spark, folders)
    assert sorted((r.source_folder, r.table_name, r.path.split("/")[-1]) for r in found.collect()) == [
        ("A", "SALES1", "sales1.dbf"),
        ("B", "ITEM", "Item.DBF"),
    ]
    assert [r.table_name for r in files.list_sources(spark, folders, only_table="item").collect()] == ["ITEM"]
    assert files.list_sources(spark, {"C": folders["C"]}).count() == 0


def test_fingerprint_is_the_md5_of_the_bytes(spark, tmp_path):
    import hashlib

    path = tmp_path / "A" / "T.DBF"
    write(path, FIELDS, RECORDS)
    row = files.fingerprints(files.list_sources(spark, {"A": str(path.parent)})).first()
    assert row.file_hash == hashlib.md5(path.read_bytes()).hexdigest()


def test_dictionary_from_headers(spark, tmp_path):
    write(tmp_path / "A" / "SALES1.DBF", [("INVNO", "N", 8, 0), ("X", "G", 10, 0)], [])
    write(tmp_path / "A" / "SALES2.DBF", [("invno", "N", 8, 0), ("Z", "Q", 1, 0)], RECORDS[:0])
    catalog = discover(spark, {"A": str(tmp_path / "A")}, str(tmp_path / "report"))
    shared = profile.find_relationships(catalog).collect()
    assert [(r.field_name, r.tables) for r in shared] == [("INVNO", "A/SALES1, A/SALES2")]
    fields = {(r.table_name, r.field_name): r for r in profile.field_dictionary(catalog).collect()}
    assert fields["SALES1", "INVNO"].is_join_key and fields["SALES1", "INVNO"].meaning == "Invoice Number"
    assert fields["SALES1", "X"].type_label == "General" and fields["SALES2", "Z"].type_label == "Unknown(Q)"
    summary = {r.source_folder: r for r in profile.table_summary(catalog).collect()}
    assert summary["TOTAL"].table_name == "2" and summary["A"].field_count == 2
    assert spark.read.json(str(tmp_path / "report")).filter("section = 'table'").count() == 2
