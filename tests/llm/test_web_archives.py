import base64
import hashlib
import io
import zipfile

import pytest

from regfuse.llm import web_archives as W

SCHEMA = "page_id bigint, url string, html string, row string, digest string, first string"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows, min_bytes=0):
    out, firsts = [], {}
    for i, _, html in rows:
        h = html or ""
        if i is not None:
            firsts[h] = min(firsts.get(h, i), i)
    seen = set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        h = html or ""
        first = len(h.encode()) < min_bytes or h not in seen
        seen.add(h)
        out.append((i, len(h.encode()), digest(h), "response" if first else "revisit", None if first else firsts.get(h)))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/x", "<p>one</p>"), (3, "http://a/y", "<p>one</p>"), (9, None, "<p>one</p>"), (4, "http://b", None), (2, "http://b/2", ""),
    (7, "http://c/ñ \r\nX-Page-Id: 1", "<p>ñandú\r\n\r\nWARC/1.1\r\n</p>"), (8, "http://d", "x" * 3_000_000), (None, "http://e", "<p>one</p>"),
    (None, "http://f", "only without an id"), (None, None, "only without an id"), (6, "http://g", "twice"), (6, "http://g", "twice"),
]


@pytest.mark.parametrize("min_bytes", [0, 6, 100])
def test_round_trip(spark, min_bytes):
    got = W.round_trip(frame(spark, ROWS), min_bytes=min_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS, min_bytes)


def test_empty_table(spark, tmp_path):
    assert W.round_trip(frame(spark, [])).collect() == []
    assert W.write_archives(frame(spark, []), f"file://{tmp_path}").collect() == []


def test_archives_are_plain_zip_and_warc(spark, tmp_path):
    manifest = W.write_archives(frame(spark, ROWS).coalesce(1), str(tmp_path), archive_bytes=200)
    paths = [r.archive for r in manifest.collect()]
    assert len(paths) > 2  # a task goes on in another archive
    for path in paths:
        with zipfile.ZipFile(path) as z:
            assert z.testzip() is None
            assert [(i.filename, i.compress_type) for i in z.infolist()] == [(W.DATA, 0), (W.INDEX, 0)]
    index = W.read_index(manifest)
    assert index.count() == len(ROWS)
    some = W.read_records(index.where("page_id in (7, 8)")).orderBy("page_id").collect()
    assert [bytes(r.payload).decode() for r in some] == [ROWS[5][2], ROWS[6][2]]
    assert some[0].url == "http://c/%C3%B1%20%0D%0AX-Page-Id:%201"


def test_only_the_wanted_ranges_are_read(tmp_path):
    writer = W.ArchiveWriter(str(tmp_path / "a.zip"))
    for i in range(50):
        writer.add(W.warc_record(str(i), i, None, b"%d" % i * 10_000, len(str(i)) * 10_000, digest(str(i) * 10_000), None), i, "response", "")
    writer.close()
    reader, read = W.ArchiveReader(str(tmp_path / "a.zip")), []
    at = reader._at
    reader._at = lambda offset, length: read.append(length) or at(offset, length)
    import json

    entry = json.loads(reader.read(W.INDEX).splitlines()[30])
    assert W.parse_record(reader.read(W.DATA, entry["offset"], entry["length"]))["payload"] == b"30" * 10_000
    assert sum(read) < reader.size


def test_zip64_comment_and_prefix(tmp_path, monkeypatch):
    plain, wide = tmp_path / "plain.zip", tmp_path / "wide.zip"
    for path in (plain, wide):
        if path == wide:  # the values that do not fit 32 bits, at a size that a test can write
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("first", b"0123456789" * 10)
            z.writestr("second", b"abc" * 20)
            z.comment = b"a comment that holds PK\x05\x06 and more than twenty-two bytes"
    raw = wide.read_bytes()
    assert b"PK\x06\x06" in raw and b"PK\x06\x07" in raw and b"PK\x06\x06" not in plain.read_bytes()
    for path in (plain, wide):
        reader = W.ArchiveReader(str(path))
        assert set(reader.members) == {"first", "second"}
        assert reader.read("first", 5, 10) == b"5678901234"
        assert reader.read("second") == b"abc" * 20
        with pytest.raises(ValueError, match="outside"):
            reader.read("second", 50, 20)


def test_damage_is_named(tmp_path):
    path = tmp_path / "x.zip"
    path.write_bytes(b"no archive")
    with pytest.raises(ValueError, match="end record"):
        W.ArchiveReader(str(path))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(W.DATA, b"x" * 100)
    path.write_bytes(out.getvalue())
    with pytest.raises(ValueError, match="compressed"):
        W.ArchiveReader(str(path)).read(W.DATA)
    record = W.warc_record("1", 1, None, b"payload", 7, digest("another"), None)
    with pytest.raises(ValueError, match="damaged"):
        W.parse_record(record)


def test_a_payload_of_a_third_of_all_rows(spark):
    rows = [(i, "http://a", "same" if i % 3 == 0 else f"text {i}") for i in range(300)]
    rows += [(0, "http://a", "same")] * 12_000  # and one that repeats its id as well
    got = W.round_trip(frame(spark, rows).repartition(7)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
