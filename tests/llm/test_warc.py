"""Archives of pages: written, read back, and read by other means."""

import hashlib
import io
import random

import pytest
import zstandard

from tarmac.llm import warc
from tarmac.llm.queries import op11_warc_archives
from tests.conftest import SF

SCHEMA = "page_id long, url string, html string, archive string, payload string, _same string, offset int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*row, "x", None, "y", 1) for row in rows], SCHEMA)


def brute(rows):
    """What the contract says, row by row."""
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        group = [p for p, _, h in rows if p is not None and (h or "").encode() == data]
        top = max(group, default=None) if len(data) >= 1000 else None
        again = top is not None and page != top
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(map(repr, out))


def results(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(repr(tuple(row[n] for n in names)) for row in df.collect())


def odd_rows():
    draw = random.Random(3)
    words = ["<p>", "näïve", "\r\n\r\n", "WARC/1.1", "text", "😀", "Content-Length: 5", "\x00", "b" * 50]
    page = lambda n: " ".join(draw.choice(words) for _ in range(n))
    shared, short = page(400), "s" * 999
    rows = [
        (None, None, None),
        (None, "u", shared),
        (1, "http://a/\r\nX-Page: 7", ""),
        (2, "http://a/b c", shared),
        (2, "http://a/b c", shared),
        (9, None, shared),
        (9, "again", shared),
        (3, "u", short),
        (4, "u", short),
        (5, "u", "s" * 1000),
        (6, "u", "s" * 1000),
        (7, "u", "é" * 500),
        (-8, "u", "é" * 500),
        (10, "long", page(300_000)),
        (None, "n", "t" * 2000),
        (None, "n", "t" * 2000),
    ]
    return rows + [(100 + i, f"http://site/{i}", page(draw.randint(0, 300))) for i in range(60)]


def test_archives_equal_brute_force(spark):
    rows = odd_rows()
    pages = pages_of(spark, rows).repartition(3)
    assert results(warc.archive(pages)) == brute(rows)


def test_payloads_and_urls_come_back(spark, tmp_path):
    rows = odd_rows()
    index = warc.write_archives(pages_of(spark, rows).coalesce(1), str(tmp_path))
    got = warc.read_archives(index, payloads=True).collect()
    urls = {repr((p, u if u is None else u.replace("\r\n", "%0D%0A").replace(" ", "%20"))) for p, u, _ in rows}
    assert {repr((r.page_id, r.url)) for r in got} == urls
    whole = sorted((r.payload_digest, bytes(r.payload)) for r in got if r.record_type == "response")
    assert all(hashlib.sha1(data).hexdigest() == digest for digest, data in whole)
    assert {data for _, data in whole} == {(h or "").encode() for _, _, h in rows}


def test_archive_is_a_dictionary_and_frames(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").coalesce(1)
    index = warc.write_archives(pages, f"file://{tmp_path}").collect()
    (file,) = tmp_path.glob("*.warc.zst")
    data = file.read_bytes()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    words = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert words.dict_id() and words.as_bytes()[:4] == bytes.fromhex("37a430ec")
    # Skipping the leading frame, any reader finds one frame a record after another.
    frames = zstandard.ZstdDecompressor(dict_data=words)
    at, plain = min(entry.offset for entry in index), 0
    assert frames.decompress(data[8 + size : at]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    for entry in sorted(index, key=lambda e: e.offset):
        assert entry.offset == at
        record = frames.decompress(data[at : at + entry.length])
        assert record == warc.record_at(entry.archive, entry.offset, entry.length)
        assert f"X-Page: {entry.page_id}\r\n".encode() in record
        plain += len(zstandard.compress(record, warc.LEVEL))
        at += entry.length
    assert at == len(data) < 0.85 * plain


def test_archives_roll_over_and_few_bytes_need_no_dictionary(spark, tmp_path, monkeypatch):
    rows = [(i, "u", f"page {i} " * 500) for i in range(20)]
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 8000)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    archive, entries = None, []
    for page, url, html in rows:
        archive = archive or warc._Archive(str(tmp_path))
        row = {"page_id": page, "url": url, "record_type": "response", "refers_to": None, "payload": html.encode()}
        row |= {"payload_bytes": len(row["payload"]), "payload_digest": hashlib.sha1(row["payload"]).hexdigest()}
        entries += archive.add(row, warc.page_record(row, "2024-01-01T00:00:00Z"))
        if archive.size >= warc.ARCHIVE_BYTES:
            entries += archive.close()
            archive = None
    if archive:
        entries += archive.close()
    assert len({e["archive"] for e in entries}) > 3 and len(entries) == 20
    assert all(warc.record_at(e["archive"], e["offset"], e["length"]).startswith(b"WARC/1.1") for e in entries)
    assert warc.dictionary([b"tiny"]) is None


def test_broken_archives_are_refused(spark, tmp_path):
    index = warc.write_archives(pages_of(spark, [(1, "u", "text " * 400)]), str(tmp_path))
    (file,) = tmp_path.glob("*.warc.zst")
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records(io.BytesIO(zstandard.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))))
    file.write_bytes(file.read_bytes()[:-3] + b"abc")
    with pytest.raises(Exception, match="(?i)zstd|checksum"):
        warc.read_archives(index).collect()


def test_no_pages(spark):
    assert warc.archive(pages_of(spark, [])).count() == 0


def test_query_reads_all_pages(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert results(op11_warc_archives(spark, SF)) == brute(rows)
