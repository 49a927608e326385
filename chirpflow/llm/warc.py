"""WARC archives in Zstandard: one frame per record, the dictionary in a leading
skippable frame.

Pages become ``response`` or ``revisit`` records: of the records with equal
payloads of at least ``min_bytes`` bytes, the one with the largest page id
carries the payload and the others refer to it.  An archive is a row
``(archive, content)`` of bounded size, written as a table of the shared folder,
so archives need no file system that every task can open.  The reader loads the
dictionary, decodes frame by frame, and checks frame headers, record headers,
lengths and digests; a damaged archive raises ``ValueError``.

Edge cases: a NULL payload counts as empty; a NULL id is lower than any other
and is written as ``null``; of equal payloads with equal ids one row is the
response and the others revisit that id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

ARCHIVE_BYTES = 8 << 20  # payload bytes after which an archive is closed
DICTIONARY_BYTES, SAMPLES = 16 << 10, 64
SALTS = 16

ARCHIVES = "archive string, records long, content binary"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url string, payload binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> bytes:
    return f"<urn:page:{'null' if page_id is None else page_id}>".encode()


def from_urn(value: bytes) -> int | None:
    if not (value.startswith(b"<urn:page:") and value.endswith(b">")):
        raise ValueError(f"not a record id of this archive: {value[:40]!r}")
    return None if value[10:-1] == b"null" else int(value[10:-1])


def record(page_id: int | None, url: str | None, payload: bytes, is_response: bool, refers_to: int | None) -> bytes:
    """One record: headers, an HTTP header block, the payload unless it is a revisit."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             + f"Content-Length: {len(payload)}\r\n\r\n".encode() + (payload if is_response else b""))
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A").encode()
    lines = [VERSION, b"WARC-Type: " + (b"response" if is_response else b"revisit"),
             b"WARC-Record-ID: " + urn(page_id), b"WARC-Target-URI: " + target,
             b"WARC-Date: 2000-01-01T00:00:00Z", b"Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest(payload)}".encode(),
             f"WARC-Block-Digest: sha1:{digest(block)}".encode(),
             f"Content-Length: {len(block)}".encode()]
    if not is_response:
        lines += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + urn(refers_to)]
    return b"\r\n".join(lines) + END + block + END


def archive(records: list[bytes]) -> bytes:
    """All records as frames, behind the dictionary's frame if one can be trained."""
    import zstandard as Z
    trained = None
    if len(records) >= 8:
        step = -(-len(records) // SAMPLES)
        try:
            trained = Z.train_dictionary(DICTIONARY_BYTES, [r[:16 << 10] for r in records[::step]], level=3)
        except Z.ZstdError:
            trained = None  # too little to train on
    pack = Z.ZstdCompressor(level=3, dict_data=trained, write_checksum=True, write_content_size=True)
    head = b""
    if trained is not None:
        raw = trained.as_bytes()
        head = struct.pack("<II", SKIPPABLE, len(raw)) + raw
    return head + b"".join(map(pack.compress, records))


def frames(content: bytes):
    """Start and end of each frame after the leading skippable one, and the dictionary."""
    import zstandard as Z
    at, raw = 0, None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", content, 4)[0]
        at = 8 + size
        if at > len(content):
            raise ValueError("the dictionary's frame is cut off")
        raw = content[8:at]
    out = []
    while at < len(content):
        try:
            head = content[at:at + 18]
            own = Z.get_frame_parameters(head)
            end = at + Z.frame_header_size(head)
        except Z.ZstdError as e:
            raise ValueError(f"no frame header at byte {at}") from e
        last = False
        while not last:
            if end + 3 > len(content):
                raise ValueError("a frame is cut off")
            block = int.from_bytes(content[end:end + 3], "little")
            last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
            end += 3 + (1 if kind == 1 else size)
        end += 4 * bool(own.has_checksum)
        if end > len(content):
            raise ValueError("a frame is cut off")
        out.append((at, end, own.content_size))
        at = end
    return out, raw


def parse(data: bytes) -> dict:
    """One record, checked."""
    head, sep, rest = data.partition(END)
    lines = head.split(b"\r\n")
    if not sep or lines[0] != VERSION:
        raise ValueError("a record without a version line")
    own = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line without a colon")
        own[name.lower()] = value.strip()
    size = int(own.get(b"content-length", b"-1"))
    if size < 0 or len(rest) != size + len(END) or rest[size:] != END:
        raise ValueError("a record's length is not the one it states")
    block = rest[:size]
    if own.get(b"warc-block-digest") != f"sha1:{digest(block)}".encode():
        raise ValueError("a block's digest is not the one it states")
    http, sep, payload = block.partition(END)
    stated = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    kind, said = own.get(b"warc-type", b"").decode(), own[b"warc-payload-digest"].decode().removeprefix("sha1:")
    if not sep or stated is None or kind not in ("response", "revisit"):
        raise ValueError("a record of another kind")
    if kind == "response" and (len(payload) != stated or digest(payload) != said):
        raise ValueError("a payload is not the one its record states")
    return {"page_id": from_urn(own[b"warc-record-id"]), "payload_bytes": stated, "payload_digest": said,
            "record_type": kind, "refers_to": from_urn(own[b"warc-refers-to"]) if kind == "revisit" else None,
            "url": own[b"warc-target-uri"].decode(), "payload": payload if kind == "response" else None}


def read(content: bytes) -> list[dict]:
    """All records of an archive."""
    import zstandard as Z
    spans, raw = frames(content)
    unpack = Z.ZstdDecompressor(dict_data=Z.ZstdCompressionDict(raw) if raw else None)
    out = []
    for a, b, size in spans:
        try:
            data = unpack.decompress(content[a:b])
        except Z.ZstdError as e:
            raise ValueError(f"the frame at byte {a} cannot be decoded") from e
        if len(data) != size:
            raise ValueError("a frame's size is not the one it states")
        out.append(parse(data))
    return out


# ---------------------------------------------------------------- on Spark

def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, is_response, refers_to)``.

    The pages are written once with a number each, which tells equal rows apart.
    Payloads that occur once need no partner; for the others the response is
    found among digests and ids alone.  That join is salted, so a payload that
    a third of all pages share is spread over ``SALTS`` tasks.  What it tells is
    written, too: Spark knows its size when it joins it to the payloads by page
    number, and moves the payloads only if it is large."""
    rows = C.write_once(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("html"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("digest", F.unhex(F.sha1("html")))
        .withColumn("size", F.octet_length("html")), "warc_pages")
    slim = rows.filter(F.col("size") >= min_bytes).select("row", "page_id", "digest")
    heads = (slim.groupBy("digest")
             .agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "row")).alias("best"))
             .filter("copies > 1")
             .select("digest", "best", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    revisits = C.write_once(
        slim.withColumn("salt", (F.col("row") % SALTS).cast("int")).join(heads, ["digest", "salt"])
        .filter(F.col("best.row") != F.col("row"))
        .select("row", F.col("best.page_id").alias("refers_to"), F.lit(False).alias("first")), "warc_revisits")
    return (rows.select("row", "page_id", "url", "html").join(revisits, "row", "left")
            .select("page_id", "url", "html", F.coalesce("first", F.lit(True)).alias("is_response"), "refers_to"))


def write(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The archives of all pages, as a table in the shared folder."""
    def run(batches):
        from pyspark import TaskContext
        part, number, records, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:06d}-{number:06d}.warc.zst"]), pa.array([len(records)], pa.int64()),
                 pa.array([archive(records)], pa.binary())], names=["archive", "records", "content"])
        for batch in C.small_batches(batches):
            for values in zip(*(batch.column(c).to_pylist() for c in
                                ("page_id", "url", "html", "is_response", "refers_to"))):
                records.append(record(*values))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield close()
                    number, records, size = number + 1, [], 0
        if records:
            yield close()
    return C.write_once(marked(pages, min_bytes).mapInArrow(run, ARCHIVES), "warc")


def records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives."""
    names = [f.split()[0] for f in RECORDS.split(", ") if payloads or f != "payload binary"]
    schema = ", ".join(f for f in RECORDS.split(", ") if payloads or f != "payload binary")
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[f.split()[1]] for f in schema.split(", ")]

    def run(batches):
        for batch in C.small_batches(batches, 1 << 20):
            for content in batch.column("content").to_pylist():
                rows = read(content)
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)],
                                                 names=names)
    return archives.select("content").mapInArrow(run, schema)
