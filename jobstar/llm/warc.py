"""WARC archives compressed with Zstandard (operator 2).

``write_archives`` puts one record per page into ``.warc.zst`` files: a
leading skippable frame holds the dictionary, then every record is one frame.
``read_archives`` loads the dictionary from that frame, decodes one frame
per record and checks version line, header fields and lengths.

Files go to and come from any place that ``pyarrow.fs`` reaches by its
address; each task writes under a temporary name and renames, so a repeated
task replaces its own file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstar.session import materialize, scratch_path

#: fixed values of the formats
SKIPPABLE_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
DICT_MAGIC = b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20  # payload bytes after which a task begins another archive
DICT_SAMPLES, DICT_BYTES = 200, 64 << 10  # records a dictionary is trained on, and its size

RECORD_SCHEMA = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
                 "payload_digest string, payload binary, archive string, record_offset bigint, error string")


class WarcError(ValueError):
    """A record or archive that does not follow the format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    if not (uri.startswith("<urn:page:") and uri.endswith(">")):
        raise WarcError(f"identifier {uri!r}")
    value = uri[10:-1]
    return None if value == "null" else int(value)


def build_record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record. A revisit has no block; its digest is that of the full payload."""
    block = b"" if revisit else payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _uri(page_id)),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "text/html"),
              ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("X-Payload-Length", str(len(payload))),
              ("Content-Length", str(len(block)))]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url)))
    if revisit:
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; raises ``WarcError`` where headers or lengths are wrong."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep:
        raise WarcError("header not ended")
    first, *lines = head.split(b"\r\n")
    if first != VERSION:
        raise WarcError(f"version {first[:20]!r}")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"header line {line[:40]!r}")
        key = name.decode("ascii", "replace").lower()
        if key in fields:
            raise WarcError(f"{key} twice")
        fields[key] = value.strip().decode("utf-8", "replace")
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if key not in fields:
            raise WarcError(f"no {key}")
    if not fields["content-length"].isdigit():
        raise WarcError("content-length is no number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"content-length {n}, found {len(rest) - 4}")
    block, kind = rest[:n], fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if payload_digest(block) != digest:
            raise WarcError("payload digest differs")
        size = n
    elif kind == "revisit":
        if n or "warc-refers-to" not in fields or not fields.get("x-payload-length", "").isdigit():
            raise WarcError("revisit without reference or with a block")
        size = int(fields["x-payload-length"])
    else:
        raise WarcError(f"record type {kind!r}")
    return {"page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None,
            "payload_bytes": size, "payload_digest": digest, "payload": block if kind == "response" else None}


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the first sample's bytes where there is too little to train on."""
    try:
        return zstd.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(samples)[:DICT_BYTES]


def _dictionary(raw: bytes) -> zstd.ZstdCompressionDict | None:
    if not raw:
        return None
    kind = zstd.DICT_TYPE_FULLDICT if raw[:4] == DICT_MAGIC else zstd.DICT_TYPE_RAWCONTENT
    return zstd.ZstdCompressionDict(raw, dict_type=kind)


def write_archive(out, records: Iterator[bytes]) -> int:
    """Write records to an open file: dictionary frame first, then a frame for each. Returns their number."""
    first = [r for _, r in zip(range(DICT_SAMPLES), records)]
    raw = train_dictionary(first)
    packed = zstd.ZstdCompressor(level=3).compress(raw) if raw else b""
    out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed)
    coder = zstd.ZstdCompressor(level=3, dict_data=_dictionary(raw), write_checksum=True, write_content_size=True)
    n = 0
    for part in (first, records):
        for r in part:
            out.write(coder.compress(r))
            n += 1
    return n


def read_archive(read) -> Iterator[tuple[int, dict | WarcError]]:
    """Records of an archive as (offset of its frame, fields or error), one frame at a time.

    ``read(n)`` gives the next bytes. A record that breaks a rule is
    reported and the next frame is read; a frame that cannot be decoded ends the archive.
    """
    head = read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE_MAGIC:
        yield 0, WarcError("no leading dictionary frame")
        return
    size = struct.unpack("<I", head[4:])[0]
    raw = read(size)
    if len(raw) != size:
        yield 0, WarcError("dictionary frame cut short")
        return
    try:
        if raw[:4] == ZSTD_MAGIC:
            raw = zstd.ZstdDecompressor().decompress(raw, max_output_size=1 << 26)
        decoder = zstd.ZstdDecompressor(dict_data=_dictionary(raw))
    except zstd.ZstdError as e:
        yield 0, WarcError(f"dictionary: {e}")
        return
    at, data = 8 + size, b""
    while True:
        data = data or read(1 << 16)
        if not data:
            return
        frame, parts, used = decoder.decompressobj(), [], 0
        try:
            while not frame.eof:
                if not data:
                    data = read(1 << 16)
                    if not data:
                        raise WarcError("frame cut short")
                parts.append(frame.decompress(data))
                used += len(data) - len(frame.unused_data)
                data = frame.unused_data
        except (zstd.ZstdError, WarcError) as e:
            yield at, WarcError(str(e))
            return
        try:
            yield at, parse_record(b"".join(parts))
        except (WarcError, ValueError) as e:
            yield at, WarcError(str(e))
        at += used


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """Add ``_payload``, ``_first`` (identifier of the response) and ``_revisit`` to each page.

    The smallest identifier of a payload is found on digests alone, with a
    partial result per task; the join back may meet a very common payload,
    whose rows the adaptive skew join splits.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    ident = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).cast("long").alias("v"))
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), "url", payload.alias("_payload"),
                        F.sha2(payload, 256).alias("_hash"))
    first = pages.select(F.sha2(payload, 256).alias("_hash"), ident.alias("_rank")).groupBy("_hash").agg(
        F.min("_rank").alias("_rank"))
    rows = rows.join(first, "_hash")
    revisit = ~F.col("_id").eqNullSafe(F.col("_rank.v")) & (F.length("_payload") >= min_bytes)
    return rows.select("_id", "url", "_payload", F.col("_rank.v").alias("_first"), revisit.alias("_revisit"))


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", payload_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page into archives under ``root``; returns a stored list of them.

    A page whose payload (null: empty) equals that of a page with a smaller
    identifier becomes a revisit of the smallest one; a null identifier
    counts as the largest. Rows that repeat identifier and payload get the
    same record each. An empty table gives no archive. Other columns are not read.
    The list is what the winning attempt of each task wrote: a lost task's
    files stay unlisted.
    """
    if "url" not in pages.columns:
        pages = pages.withColumn("url", F.lit(None).cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base)
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(5))))
        row = next(rows, None)
        while row is not None:
            name = f"{base}/{uuid.uuid4().hex}.warc.zst"
            size = 0

            def records():
                nonlocal row, size
                while row is not None and size < archive_bytes:
                    ident, url, payload, first, again = row
                    size += len(payload)
                    yield build_record(ident, url, payload, first, again)
                    row = next(rows, None)

            with store.open_output_stream(name + ".part") as out:
                n = write_archive(out, records())
            store.move(name + ".part", name)
            yield pa.RecordBatch.from_pydict({"archive": [name.rpartition("/")[2]], "records": pa.array([n], pa.int64())})

    rows = with_revisits(pages, id_col, payload_col, min_bytes)
    return materialize(rows.mapInArrow(write, "archive string, records bigint"), "warc-list")


def read_archives(archives: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """Records of the listed archives under ``root``, one row each.

    A record or frame that breaks the format gives a row with ``error`` set
    and the rest null. ``payload`` is null for revisits.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def batch(rows, archive):
            columns = [pa.array([r[1].get(n) if with_payload or n != "payload" else None for r in rows], t)
                       for n, t in zip(names, types)]
            columns += [pa.array([archive] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "archive", "record_offset", "error"])

        for b in batches:
            for archive in b.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{base}/{archive}", compression=None) as f:
                    for at, found in read_archive(f.read):
                        bad = isinstance(found, WarcError)
                        rows.append((at, {} if bad else found, str(found) if bad else None))
                        size += 0 if bad else found["payload_bytes"]
                        if size > 4 << 20 or len(rows) >= 2000:
                            yield batch(rows, archive)
                            rows, size = [], 0
                if rows:
                    yield batch(rows, archive)

    n = archives.sparkSession.sparkContext.defaultParallelism
    return archives.select("archive").repartition(n).mapInArrow(read, RECORD_SCHEMA)


def warc_roundtrip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` into archives in the shared folder and read them back: a row per page.

    A null payload counts as empty, a null identifier as the largest; of rows that repeat identifier and
    payload each gives a row. A missing or null ``url`` is left out of the record. An empty table gives an empty
    result; other columns are not read. ``error`` is null unless an archive was damaged between writing and reading.
    """
    spark: SparkSession = pages.sparkSession
    root = scratch_path(spark, "warc")
    return read_archives(write_archives(pages, root, id_col, payload_col, min_bytes), root)
