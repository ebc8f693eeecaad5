"""Memo files, end marks and fingerprints over several ranges, limited reads."""

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from ledgerspark.plans import profile
from ledgerspark.sources import files, memos, xbase
from tests.dbf_files import dbf, write

TEXTS = ["first note", "café — naïve", "x" * 3000, "line\r\nline", " padded ", "é" * 700]


def fpt(texts, block=64):
    """FoxPro memo bytes and the block number of each text; None makes a picture."""
    out, at = bytearray(struct.pack(">I2xH504x", 0, block)), []
    for text in texts:
        at.append(len(out) // block)
        raw = text.encode("cp1252") if text is not None else b"picture"
        out += struct.pack(">II", 1 if text is not None else 0, len(raw)) + raw
        out += b"\0" * (-len(out) % block)
    return bytes(out), at


def dbt3(texts):
    out, at = bytearray(b"\0" * 512), []
    for text in texts:
        at.append(len(out) // 512)
        out += text.encode("cp1252") + b"\x1a\x1a"
        out += b"\0" * (-len(out) % 512)
    return bytes(out), at


def dbt4(texts, block=128):
    out, at = bytearray(struct.pack("<20xH490x", block)), []
    out += b"\0" * (-len(out) % block)
    for text in texts:
        at.append(len(out) // block)
        raw = text.encode("cp1252")
        out += b"\xff\xff\x08\x00" + struct.pack("<I", len(raw) + 8) + raw
        out += b"\0" * (-len(out) % block)
    return bytes(out), at


def notes(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("_seq").collect()]


@pytest.mark.parametrize("make, ending, version", [(fpt, "fpt", 0xF5), (fpt, "FPT", 0x30), (dbt3, "DBT", 0x83), (dbt4, "dbt", 0x8B)])
def test_memo_texts(spark, tmp_path, monkeypatch, make, ending, version):
    monkeypatch.setattr(memos, "WINDOW_BYTES", 1000)
    monkeypatch.setattr(memos, "BATCH_BYTES", 2000)
    body, at = make(TEXTS)
    binary = version == 0x30
    spot = (lambda n: struct.pack("<I", n)) if binary else (lambda n: str(n).rjust(10) if n else "")
    records = [(" ", str(i), spot(n)) for i, n in enumerate([*at, at[0], 0, 99_999])] + [("*", "9", spot(at[1]))]
    blob = dbf([("ID", "C", 2, 0), ("NOTE", "M", 4 if binary else 10, 0)], records)
    (tmp_path / "T.DBF").write_bytes(bytes([version]) + blob[1:])
    (tmp_path / f"T.{ending}").write_bytes(body)
    got = notes(xbase.read_xbase(spark, [str(tmp_path / "T.DBF")], split_bytes=40), "id", "note")
    plain = xbase.read_xbase(spark, [write(tmp_path / "P.DBF", [("C", "C", 254, 0)], [(" ", t[:250]) for t in TEXTS])])
    shown = [r[0] for r in notes(plain, "c")]
    assert [n for _, n in got][:2] == shown[:2] and [n for _, n in got][3:5] == shown[3:5]  # cleaned like other texts
    assert got[2][1] == TEXTS[2] and got[5][1] == TEXTS[5]
    assert got[6][1] == got[0][1] and got[7:] == [("7", None), ("8", None)]


def test_several_memo_fields_files_and_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(memos, "RANGE_BYTES", 4096)
    fields, paths, want = [("A", "M", 10, 0), ("B", "M", 10, 0)], [], set()
    for folder in "XYZ":
        texts = [f"{folder}{i} " + "t" * (37 * i % 500) for i in range(60)]
        body, at = fpt([t if i % 9 else None for i, t in enumerate(texts)])
        paths.append(write(tmp_path / folder / "T.DBF", fields, [(" ", str(a), str(b)) for a, b in zip(at, at[::-1])]))
        if folder != "Z":  # without a memo file
            (tmp_path / folder / "T.FPT").write_bytes(body)
        shown = [None if folder == "Z" or i % 9 == 0 else t.strip() for i, t in enumerate(texts)]
        want |= {(p, i, a, b) for p in [paths[-1]] for i, (a, b) in enumerate(zip(shown, shown[::-1]))}
    rows = xbase.read_xbase(spark, paths)
    assert rows.columns == ["_source_path", "_seq", "a", "b"]
    assert {tuple(r) for r in rows.collect()} == want
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "CartesianProduct" not in text


def test_broken_memo_files_give_null(spark, tmp_path):
    path = write(tmp_path / "T.DBF", [("A", "M", 10, 0)], [(" ", "8"), (" ", "x"), (" ", "-3")])
    for body in (b"", b"\0" * 30, struct.pack(">I2xH504x", 0, 64) + struct.pack(">II", 1, 500) + b"short"):
        (tmp_path / "T.FPT").write_bytes(body)
        assert notes(xbase.read_xbase(spark, [path]), "a") == [(None,)] * 3


# ---- end mark


def test_the_end_mark_is_searched_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(xbase, "SPLIT_BYTES", 100)
    monkeypatch.setattr(xbase, "BATCH_BYTES", 50)
    fields = [("A", "C", 9, 0)]
    blob = dbf(fields, [(" ", f"r{i}") for i in range(200)], tail=b"")
    marked = blob + b"\x1a" + b" left over" * 30  # rubbish behind the mark
    later = blob + b" " + b"z" * 9 + b"\x1a" + b" left over" * 30
    reads = []
    real = xbase.open_location

    def watched(path):
        system, inner = real(path)
        reads.append(inner)
        return system, inner

    monkeypatch.setattr(xbase, "open_location", watched)
    for name, body, header, want in (("a", marked, 7, 200), ("b", later, 200, 201), ("c", blob, 500, 200), ("d", marked, 200, 200)):
        path = tmp_path / f"{name}.DBF"
        path.write_bytes(body[:4] + struct.pack("<I", header) + body[8:])
        reads.clear()
        assert xbase.record_counts(spark, [str(path)]) == [want], name
        assert len(reads) <= 3  # header, size and one byte: tasks read the flags elsewhere
        assert xbase.read_xbase(spark, [str(path)], split_bytes=64).count() == want
    with pytest.raises(Exception, match="number of records"):
        spark.read.format("xbase").option("path", str(tmp_path / "a.DBF")).load().count()


# ---- fingerprints


def test_a_fingerprint_is_hashed_by_ranges(spark, tmp_path):
    path = tmp_path / "A" / "T.DBF"
    path.parent.mkdir()
    body = bytes(range(256)) * 40
    path.write_bytes(body)
    listed = files.list_sources(spark, {"A": str(path.parent)})
    want = hashlib.md5("".join(hashlib.md5(body[i : i + 1000]).hexdigest() for i in range(0, len(body), 1000)).encode()).hexdigest()
    found = files.fingerprints(listed, 1000)
    assert [(r.path.endswith("T.DBF"), r.file_hash) for r in found.collect()] == [(True, want)]
    assert files.fingerprints(listed.repartition(3), 1000).first().file_hash == want
    path.write_bytes(body[:5000] + b"!" + body[5001:])
    assert files.fingerprints(listed, 1000).first().file_hash != want
    path.write_bytes(b"")
    gone = str(tmp_path / "gone.DBF")
    odd = spark.createDataFrame([("A", "T", str(path), 0, None), ("A", "G", gone, 5, None)], files.FILE_COLUMNS)
    assert {r.table_name: r.file_hash for r in files.fingerprints(odd, 1000).collect()} == {"T": hashlib.md5().hexdigest(), "G": None}


# ---- limited reads


def test_a_limit_reads_one_range_and_stops(spark, tmp_path):
    flags = "*x" + " " * 3 + "*" * 40 + " " * 500
    path = write(tmp_path / "A" / "T.DBF", [("N", "N", 5, 0), ("D", "D", 8, 0)], [(f, str(i), "20250102") for i, f in enumerate(flags)])
    few = write(tmp_path / "B" / "T.DBF", [("N", "N", 5, 0), ("D", "D", 8, 0)], [(" ", "1", "")], tail=b"\x1a garbage garbage")
    scan = xbase.scan_records(spark, [path, few], split_bytes=32, limit=5)
    assert scan.rdd.getNumPartitions() == 2 and scan.count() < 60
    rows = xbase.read_xbase(spark, [path, few], limit=5)
    assert sorted((r._source_path == path, int(r.n)) for r in rows.collect()) == [(False, 1), (True, 2), (True, 3), (True, 4), (True, 45), (True, 46)]
    assert xbase.read_xbase(spark, [path], limit=0).count() == 0


def test_samples_of_files(spark, tmp_path):
    for folder in "AB":
        write(tmp_path / folder / "T.DBF", [("N", "N", 5, 0), ("S", "C", 3, 0)], [(" ", str(i), "x" if i else "") for i in range(9)])
        write(tmp_path / folder / "U.DBF", [("K", "C", 3, 0)], [("*", "no"), (" ", "yes")])
    listed = files.list_sources(spark, {f: str(tmp_path / f) for f in "AB"})
    found = profile.sample_files(spark, listed, rows=2)
    got = sorted((r.source_folder, r.table_name, r.row_no, tuple(sorted(r["values"].items()))) for r in found.collect())
    assert got == [
        *[x for f in "AB" for x in ((f, "T", 1, (("n", "0"), ("s", ""))), (f, "T", 2, (("n", "1"), ("s", "x"))), (f, "U", 1, (("k", "yes"),)))]
    ]
    assert found.agg(F.max("row_no")).first()[0] == 2
