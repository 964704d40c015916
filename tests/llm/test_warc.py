import hashlib
import io
import os

import pytest
import zstandard

from carelayers.llm import warc


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def brute(rows):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        refers = first.get(html)
        refers = refers if page is not None and refers is not None and page > refers else None
        kind = "response" if refers is None else "revisit"
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers))
    return sorted(map(str, out))


def round_trip(spark, rows, folder, **how):
    index = warc.write_archives(table(spark, rows), str(folder), **how)
    found = warc.read_archives(index).collect()
    return index, sorted(map(str, map(tuple, found)))


def test_whole_table(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    index, found = round_trip(spark, rows, tmp_path / "a", archive_bytes=20_000)
    assert found == brute(rows)
    assert index.select("uri").distinct().count() > 1
    # A record is read alone with its offset and the dictionary in the first frame.
    for row in index.limit(20).collect():
        with open(row.uri, "rb") as file:
            data = file.read()
        assert int.from_bytes(data[:4], "little") == 0x184D2A5D
        size = int.from_bytes(data[4:8], "little")
        words = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        frame = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(data[row.offset :])
        assert frame.startswith(b"WARC/1.1\r\n") and f"<urn:page:{row.id}>".encode() in frame
    (payload,) = [r["payload"] for r in _records(index.first().uri) if r["page_id"] == index.first().id]
    assert payload.decode() == {r[0]: r[2] for r in rows}[index.first().id]


def _records(uri):
    with open(uri, "rb") as file:
        return list(warc.read_records(io.BytesIO(file.read())))


def test_copies_and_odd_rows(spark, tmp_path):
    big, small = "é" * 60, "s" * 99
    rows = [
        (5, "http://x/ü\r\nWARC-Type: evil", big), (3, "u", big), (9, None, big), (3, "u", big), (None, "u", big),
        (1, "u", small), (2, "u", small), (10, "u", None), (11, "u", ""), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 20),
        (13, "u", "long " * 200_000), (14, "u", "long " * 200_000),
    ]
    assert round_trip(spark, rows, tmp_path / "a")[1] == brute(rows)
    hot = rows + [(100 + i, "u", big) for i in range(500)] + [(1000 + i, "u", f"{i} " * 60) for i in range(300)]
    assert round_trip(spark, hot, tmp_path / "b")[1] == brute(hot)
    wide = table(spark, rows).selectExpr("*", "1 as id", "2 as digest", "3 as first", "4 as key", "5 as hot")
    index = warc.write_archives(wide, str(tmp_path / "c"))
    assert sorted(map(str, map(tuple, warc.read_archives(index).collect()))) == brute(rows)


def test_cold_copies_join_by_digest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "HOT_SHARE", 1)  # nothing is hot
    rows = [(i, "u", f"{i % 40} " * 80) for i in range(200)]
    assert round_trip(spark, rows, tmp_path / "a")[1] == brute(rows)


def test_empty_table(spark, tmp_path):
    index, found = round_trip(spark, [], tmp_path / "a")
    assert found == [] and index.count() == 0
    assert not [f for f in os.listdir(tmp_path / "a") if f.endswith(".zst")]


def test_damage_is_seen(spark, tmp_path):
    rows = [(i, "u", f"{i} abc " * 100) for i in range(30)]
    index, _ = round_trip(spark, rows, tmp_path / "a")
    row = index.orderBy("uri", "offset").collect()[-1]
    with open(row.uri, "rb") as file:
        whole = file.read()
    for cut in (5, len(whole) - row.offset - 3):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_records(io.BytesIO(whole[:-cut])))
    with open(row.uri, "wb") as file:  # the last record is gone as a whole
        file.write(whole[: row.offset])
    with pytest.raises(Exception, match="records, the index"):
        warc.read_archives(index).collect()
