"""WARC archives of web pages, compressed record by record against a dictionary of their own.

Each task writes its pages to archives in the shared folder. An archive begins with a skippable
Zstandard frame that holds a dictionary built from its own first records (``SAMPLE_BYTES`` of them
at most); after it every record is a frame of its own, compressed with that dictionary, so any
record can be read alone from its offset. Readers need nothing but the file: they take the
dictionary from the leading frame and then read record after record.

Pages with equal payloads of ``LEAST`` bytes or more are archived once, under the largest page_id;
the others become revisit records that refer to it. Groups are found by SHA-256 of the payload and
counted before any row moves, so a payload that very many pages share costs one row of a small
table, and pages themselves move only where that table is too large to be broadcast.

Archives have names of their own for each attempt of a task, and only those that the written index
lists are read, so a lost executor or a repeated task leaves no wrong record, at most a stray file.

Results in odd cases: NULL html is an empty payload, and short payloads are always responses. A
NULL page_id counts as smaller than all others; a group that has no other is all responses. Rows that
repeat the largest page_id of their group are all responses, as no record refers to itself. NULL
urls read back as NULL; white space and control characters of a url are percent-encoded in the
record's header. An empty table yields no archive and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.config import durable, scratch_path

# Payloads below this many bytes are always stored whole.
LEAST = 1000
# Bytes of an archive's first records that its dictionary is built from, and the dictionary's size.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
# A new archive begins after so many bytes of records.
ARCHIVE_BYTES = 256 << 20
LEVEL = 6
# Skippable frame that holds a dictionary (Zstandard, RFC 8878, and its use in WARC files).
DICTIONARY_FRAME = 0x184D2A5D.to_bytes(4, "little")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
INDEX = f"{ENTRY}, archive string, offset long, length long"


# --- which pages are revisits


def typed(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its size and digest, record_type and the page that a revisit refers to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("_same", F.sha2("payload", 256))
    shared = (
        rows.filter(F.octet_length("payload") >= LEAST)
        .groupBy(F.col("_same").alias("_group"))
        .agg(F.max("page_id").alias("_kept"), F.count("*").alias("_n"))
        .filter("_n > 1 AND _kept IS NOT NULL")
        .drop("_n")
    )
    # Written, so Spark knows its size when it chooses the join.
    shared = durable(shared, "shared-payloads")
    again = F.col("_kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_kept"))
    return rows.join(shared, rows["_same"] == shared["_group"], "left").select(
        "page_id",
        "url",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_kept")).alias("refers_to"),
        "payload",
    )


# --- records


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    named = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{named}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def page_record(row: dict, archived_at: str) -> bytes:
    """The response or revisit record of a page; a revisit keeps the HTTP head, without the payload."""
    revisit = row["record_type"] == "revisit"
    url = row["url"]
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _record_id(row["page_id"], row["payload_digest"])),
        ("WARC-Date", archived_at),
        ("WARC-Target-URI", target if target is not None else f"urn:page:{row['page_id']}"),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id(row["refers_to"], row["payload_digest"]) if revisit else None),
        ("X-Refers-To-Page", row["refers_to"]),
        ("X-Page", row["page_id"]),
        ("X-No-URL", None if url is not None else "1"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(fields, head.encode() + (b"" if revisit else row["payload"]))


# --- archives


def dictionary(records: Iterable[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of common passages, or None if the records are too few or too plain for one."""
    pieces, left = [], SAMPLE_BYTES
    for record in records:
        kept = record[:left]
        pieces += [kept[at : at + 4096] for at in range(0, len(kept), 4096)]
        left -= len(kept)
        if left <= 0:
            break
    size = min(size, (SAMPLE_BYTES - left) // 8)
    try:
        return zstandard.train_dictionary(size, pieces, k=512, d=8) if size >= 256 else None
    except zstandard.ZstdError:
        return None


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))


class _Archive:
    """One archive: records wait until they fill the dictionary's sample, later ones pass through."""

    def __init__(self, folder: str):
        self.path = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst"
        self.waiting: list[tuple[dict, bytes]] = []
        self.size, self.at, self.out, self.zip = 0, 0, None, None

    def add(self, row: dict, record: bytes) -> Iterator[dict]:
        self.size += len(record)
        if self.out:
            yield self._written(row, record)
            return
        self.waiting.append((row, record))
        if self.size >= SAMPLE_BYTES:
            yield from self._open()

    def close(self) -> Iterator[dict]:
        if not self.out:
            yield from self._open()
        self.out.close()

    def _open(self) -> Iterator[dict]:
        store, path = _store(self.path)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)
        words = dictionary(record for _, record in self.waiting)
        if words:
            words.precompute_compress(level=LEVEL)
            held = words.as_bytes()
            self._put(DICTIONARY_FRAME + len(held).to_bytes(4, "little") + held)
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=True)
        about = b"software: tarmac\r\nformat: WARC File Format 1.1\r\n"
        name = self.path.rpartition("/")[2]
        fields = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ]
        self._put(self.zip.compress(_record(fields, about)))
        for row, record in self.waiting:
            yield self._written(row, record)
        self.waiting = []

    def _written(self, row: dict, record: bytes) -> dict:
        begin = self.at
        self._put(self.zip.compress(record))
        return {**row, "archive": self.path, "offset": begin, "length": self.at - begin}

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)


def write_archives(pages: DataFrame, folder: str, archived_at: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archive all pages below ``folder``; returns the index: a row per record with its place.

    ``folder`` is a path or address that all executors reach. ``archived_at`` is the date in the
    records, fixed by default so that reruns agree.
    """
    names = [field.split()[0] for field in INDEX.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in INDEX.split(", ")])

    def listed(entries: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[n] for e in entries], schema.field(n).type) for n in names], schema=schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            entries = []
            for row in _rows(batch):
                archive = archive or _Archive(folder)
                record = page_record(row, archived_at)
                del row["payload"]
                entries += archive.add(row, record)
                if archive.size >= ARCHIVE_BYTES:
                    entries += archive.close()
                    archive = None
            if entries:
                yield listed(entries)
        if archive:
            yield listed(list(archive.close()))

    # Written at once: the archives exist when this returns, and each is listed once.
    return durable(typed(pages).mapInArrow(write, INDEX), "warc-index")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in columns.items()}


# --- reading


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive that is open for reading."""
    words, begun = None, source.read(4)
    if begun == DICTIONARY_FRAME:
        words = zstandard.ZstdCompressionDict(source.read(int.from_bytes(source.read(4), "little")))
        begun = b""
    frames = zstandard.ZstdDecompressor(dict_data=words).stream_reader(
        _Joined(begun, source), read_across_frames=True
    )
    held = b""
    while True:
        while b"\r\n\r\n" not in held:
            more = frames.read(1 << 16)
            if not more:
                if held:
                    raise ValueError("an archive ends inside a record")
                return
            held += more
        head, _, held = held.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record: {version[:40]}")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"]) + 4
        parts, got = [held], len(held)
        while got < size:
            more = frames.read(max(1 << 16, size - got))
            if not more:
                raise ValueError("an archive ends inside a record")
            parts.append(more)
            got += len(more)
        body = b"".join(parts)
        held = body[size:]
        yield fields, body[: size - 4]


class _Joined:
    """A source with some bytes put back at its front."""

    def __init__(self, front: bytes, source):
        self.front, self.source = front, source

    def read(self, size: int = -1) -> bytes:
        front, self.front = self.front, b""
        return front or self.source.read(size)


def record_at(archive: str, offset: int, length: int) -> bytes:
    """One record, read alone: the archive's dictionary and the record's own frame."""
    store, path = _store(archive)
    with store.open_input_file(path) as source:
        words = None
        if source.read(4) == DICTIONARY_FRAME:
            words = zstandard.ZstdCompressionDict(source.read(int.from_bytes(source.read(4), "little")))
        source.seek(offset)
        return zstandard.ZstdDecompressor(dict_data=words).decompress(source.read(length))


def _page(fields: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != said):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number, other = fields.get("X-Page"), fields.get("X-Refers-To-Page")
    return {
        "page_id": None if number is None else int(number),
        "url": None if "X-No-URL" in fields else fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": said,
        "record_type": fields["WARC-Type"],
        "refers_to": None if other is None else int(other),
        "payload": None if fields["WARC-Type"] == "revisit" else payload,
    }


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """The page records of all archives of an index, read from the archives themselves.

    A response whose payload differs from its digest ends the job. With ``payloads`` the column
    ``payload`` holds the bytes, NULL for revisits.
    """
    paths = index.select("archive").distinct()
    # One task per archive; so few bytes a path would otherwise put all archives in one task.
    paths = paths.repartition(max(1, paths.count()))
    wanted = ENTRY + (", payload binary" if payloads else "")
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in wanted.split(", ")])

    def batch_of(pages: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[f.name] for p in pages], f.type) for f in schema], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, path = _store(archive)
                pages, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for fields, block in records(source):
                        if fields["WARC-Type"] not in ("response", "revisit"):
                            continue
                        pages.append(_page(fields, block))
                        held += len(block) if payloads else 200
                        if held >= 4 << 20:
                            yield batch_of(pages)
                            pages, held = [], 0
                if pages:
                    yield batch_of(pages)

    return paths.mapInArrow(read, wanted)


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the application's part of the shared folder and read them back."""
    return read_archives(write_archives(pages, scratch_path(pages.sparkSession, "warc")))
