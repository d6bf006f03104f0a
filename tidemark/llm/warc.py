"""WARC archives in Zstandard: one frame per record, the dictionary in front.

Spark decides which of the pages with equal payloads (by SHA-1 and size) is the
response, and tasks write their rows as archives: a skippable frame
(0x184D2A5D) with a dictionary trained on the first records, then a frame for
each record.  The reader streams an archive: it loads the dictionary from the
leading skippable frame, decodes one frame per record, and checks the version
line, the headers, the block length, both digests, and that a frame holds one
record and no more; anything else raises ``WarcError``.  Archives get names of
their own per attempt and only those of committed tasks are in the manifest.

A ``response`` block is an HTTP header and the payload; a ``revisit`` block is
the HTTP header alone, whose Content-Length tells the size of the payload.

Rows: one record per row of the pages.  A null html is an empty payload, a null
url gives no target header, a null id is written as null and never refers or is
referred to.  Rows that repeat the id of a response are responses too.  An empty
table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import locate, make_folder
from tidemark.llm.store import looked_up, ship_package, stored

MIN_REVISIT_BYTES = 1000
DATE = "2025-01-01T00:00:00Z"
#: A new archive begins beyond this size; the dictionary is trained on this many
#: records or bytes at the beginning of an archive.
ARCHIVE_BYTES = 256 << 20
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 4 << 20, 32 << 10
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


def _name(page_id: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + page_id)}>"


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url: str | None, payload: bytes, response_id) -> bytes:
    """A response record, or a revisit of the page ``response_id`` where that isn't None."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = _digest(payload)
    key = json.dumps(page_id)
    headers = [("WARC-Type", "response" if response_id is None else "revisit"), ("WARC-Record-ID", _name(key)),
               ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", digest), ("WARC-Page-ID", key)]
    if url is not None:
        headers.append(("WARC-Target-URI", _one_line(url)))
    if response_id is None:
        block += payload
    else:
        refers = json.dumps(response_id)
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers)), ("WARC-Refers-To-Page-ID", refers)]
    headers += [("WARC-Block-Digest", _digest(block)), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode().split("\r\n"):
        key, colon, value = line.partition(": ")
        if not colon or not key:
            raise WarcError(f"bad header line {line[:80]!r}")
        out[key.lower()] = value
    return out


def parse(data: bytes) -> dict:
    """The validated record of one frame."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version != b"WARC/1.1":
        raise WarcError(f"no WARC/1.1 record: {data[:40]!r}")
    headers = _headers(lines)
    try:
        kind, length = headers["warc-type"], int(headers["content-length"])
        key, digest = json.loads(headers["warc-page-id"]), headers["warc-payload-digest"]
        if headers["warc-record-id"] != _name(headers["warc-page-id"]) or kind not in ("response", "revisit"):
            raise WarcError(f"bad record id or type of page {key}")
        if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
            raise WarcError(f"page {key}: the block has {len(rest) - 4} bytes, the header says {length}")
        block = rest[:length]
        if _digest(block) != headers["warc-block-digest"]:
            raise WarcError(f"page {key}: the block does not match its digest")
        http, gap, payload = block.partition(b"\r\n\r\n")
        size = int(_headers(http.partition(b"\r\n")[2])["content-length"])
        refers = json.loads(headers["warc-refers-to-page-id"]) if kind == "revisit" else None
    except KeyError as e:
        raise WarcError(f"header {e} is missing") from e
    if kind == "response" and (len(payload) != size or _digest(payload) != digest):
        raise WarcError(f"page {key}: the payload does not match its length or digest")
    if kind == "revisit" and (payload or headers.get("warc-refers-to") != _name(headers["warc-refers-to-page-id"])):
        raise WarcError(f"page {key}: a revisit holds a payload or refers to no record")
    return {"page_id": key, "url": headers.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(), "record_type": kind,
            "refers_to": refers, "payload": payload if kind == "response" else None}


class ArchiveWriter:
    """Writes records to one archive; the first ones are held back to train the dictionary."""

    def __init__(self, stream):
        self.stream, self.held, self.size, self.compressor, self.records = stream, [], 0, None, 0

    def write(self, data: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self.size += self.stream.write(self.compressor.compress(data))
            return
        self.held.append(data)
        self.size += len(data)
        if len(self.held) >= SAMPLE_RECORDS or self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        import zstandard

        trained = None
        if len(self.held) >= 16:
            try:
                trained = zstandard.train_dictionary(DICTIONARY_BYTES, [x[:1 << 16] for x in self.held])
            except zstandard.ZstdError:  # too little or too uniform a sample: no dictionary
                trained = None
        self.size = 0
        if trained is not None:
            raw = zstandard.ZstdCompressor().compress(trained.as_bytes())
            self.size += self.stream.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained)
        for data in self.held:
            self.size += self.stream.write(self.compressor.compress(data))
        self.held = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.stream.close()


def read_archive(stream, chunk: int = 1 << 20) -> Iterator[dict]:
    """The records of an archive, one frame at a time."""
    import zstandard

    data, dictionary = stream.read(8), None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", data[4:])[0]
        raw = stream.read(size)
        if len(raw) != size:
            raise WarcError("the dictionary frame is cut short")
        if raw[:4] == FRAME:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary, data = zstandard.ZstdCompressionDict(raw), b""
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        data = data or stream.read(chunk)
        if not data:
            return
        frame, parts = decoder.decompressobj(), []
        try:
            while not frame.eof:
                if not data and not (data := stream.read(chunk)):
                    raise WarcError("the last frame is cut short")
                parts.append(frame.decompress(data))
                data = frame.unused_data if frame.eof else b""
        except zstandard.ZstdError as e:
            raise WarcError(f"bad frame: {e}") from e
        yield parse(b"".join(parts))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the archives below ``folder``; returns the manifest (name, records, bytes)."""
    ship_package(pages.sparkSession)
    make_folder(folder)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8").alias("payload")) \
        .withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    # a null id comes after all: it refers to its twin and is no one's
    seen = stored(rows.where(F.col("size") >= min_bytes).groupBy("digest", "size")
                  .agg(F.max("id").alias("response"), F.count("*").alias("rows"))
                  .where("rows > 1 AND response IS NOT NULL"), "warc-twins")
    total = seen.agg(F.sum("rows")).first()[0] or 0
    candidates = rows.where(F.col("size") >= min_bytes)
    twins = looked_up(candidates, seen, ["digest", "size"], total) \
        .select("id", "url", "payload", F.when(~F.col("response").eqNullSafe(F.col("id")), F.col("response")).alias("response"))
    alone = candidates.join(seen, ["digest", "size"], "left_anti").unionByName(rows.where(F.col("size") < min_bytes)) \
        .select("id", "url", "payload", F.lit(None).cast(pages.schema[id_col].dataType).alias("response"))
    marked = twins.unionByName(alone)

    def run(batches):
        fs, base = locate(folder)
        writer, name = None, ""

        def closed():
            writer.close()
            return pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([writer.records], pa.int64()),
                                               "bytes": pa.array([writer.size], pa.int64())})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is not None and writer.size >= ARCHIVE_BYTES:
                    yield closed()
                    writer = None
                if writer is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(fs.open_output_stream(f"{base}/{name}"))
                writer.write(record(*row))
        if writer is not None:
            yield closed()

    return stored(marked.mapInArrow(run, "name string, records bigint, bytes bigint"), "warc-manifest")


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame, id_type: str = "bigint",
              id_col: str = "page_id", payloads: bool = False) -> DataFrame:
    """Per record: id, url, ``payload_bytes`` and ``payload_digest`` (of the full payload),
    ``record_type``, ``refers_to``, and with ``payloads`` the payload of responses."""
    ship_package(spark)
    schema = f"{id_col} {id_type}, url string, payload_bytes bigint, payload_digest string, record_type string, " \
             f"refers_to {id_type}" + (", payload binary" if payloads else "")
    count = max(1, manifest.count())

    def run(batches):
        fs, base = locate(folder)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{base}/{name}") as stream:
                    rows, seen, held = [], 0, 0
                    for row in read_archive(stream):
                        row[id_col] = row.pop("page_id")
                        held += len(row["payload"] or b"")
                        if not payloads:
                            del row["payload"]
                        rows.append(row)
                        seen += 1
                        if len(rows) >= 5000 or (payloads and held > 8 << 20):
                            yield pa.RecordBatch.from_pylist(rows, schema=_types(id_type, id_col, payloads))
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_types(id_type, id_col, payloads))
                if seen != records:
                    raise WarcError(f"{name} holds {seen} records, the manifest says {records}")

    return manifest.repartition(count).mapInArrow(run, schema)


def _types(id_type: str, id_col: str, payloads: bool) -> pa.Schema:
    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    return pa.schema([(id_col, kind), ("url", pa.string()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", kind)]
                     + ([("payload", pa.binary())] if payloads else []))
