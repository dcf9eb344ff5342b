"""WARC archives compressed with a shared zstandard dictionary.

An archive is a .warc.zst file: a skippable frame that embeds the dictionary, then one
frame per record.  The dictionary is trained on a bounded sample of the records themselves.
Of records with equal payloads of at least ``min_bytes`` bytes, the one with the smallest
page_id is a response and the others are revisits that refer to it and hold only their HTTP
header; smaller payloads are all responses.

Equal payloads are found by (SHA-1, length), aggregated map-side to one row per digest; the
few that occur more than once are written out and joined back, a join whose hot digests AQE
can split.  Tasks then write one archive each.

Defined results: a null html is the empty payload; a null page_id is larger than any other
and leaves the page header out; of repeated rows (same page_id and payload) one is the
response; a null url is written as ``urn:page:<page_id>``; control characters and spaces of
a url are percent-encoded; very long pages are written whole; an empty table gives no archive; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.llm import files
from fulcrum.llm.scratch import Scratch
from fulcrum.llm.token_files import dictionary_from

DICT_FRAME = 0x184D2A5D  # skippable frame that holds the dictionary (fixed value)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SAMPLE_RECORDS, SAMPLE_BYTES = 1000, 16 * 1024
DICT_BYTES = 112 * 1024
LEVEL = 3


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _uri(url: str | None, page: int | None) -> str:
    if not url:
        return f"urn:page:{page}"
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None,
           revisit: bool = False) -> bytes:
    """One WARC record; ``digest`` is base 32."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_uri(url, page)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-Id: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archive(out, records: Iterator[bytes], dictionary: bytes) -> None:
    out.write(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
    for r in records:
        out.write(packer.compress(r))


def read_archive(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; the dictionary comes from the file itself."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICT_FRAME:
        raise ValueError("the archive does not start with its dictionary")
    dictionary = zstandard.ZstdCompressionDict(file.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(file, read_across_frames=True)
    data, at = b"", 0

    def need(n: int) -> bool:
        nonlocal data, at
        while len(data) - at < n:
            more = reader.read(max(1 << 20, n))
            if not more:
                return False
            data, at = data[at:] + more, 0
        return True

    while need(1):
        end = data.find(b"\r\n\r\n", at)
        while end < 0:
            if not need(len(data) - at + 1):
                raise ValueError("the archive ends inside a record")
            end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        at = end + 4
        n = int(headers["Content-Length"])
        if not need(n + 4):
            raise ValueError("the archive ends inside a record")
        yield headers, data[at:at + n]
        at += n + 4


def train_dictionary(pages: DataFrame) -> bytes:
    every = max(1, pages.count() // SAMPLE_RECORDS)
    sample = (
        pages.where(F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0)
        .select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
        .select("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))
        .limit(2 * SAMPLE_RECORDS).collect())
    return dictionary_from(
        [record(r.page_id, r.url, bytes(r.payload), base32_digest(hashlib.sha1(r.payload).hexdigest())) for r in sample],
        DICT_BYTES)


def deduplicated(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest (SHA-1, hex), refers_to, revisit."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    base = base.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    page = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"))
    firsts = scratch.write(
        base.where(F.col("size") >= min_bytes).groupBy("digest", "size", "page_id").agg(F.count(F.lit(1)).alias("same"))
        .groupBy("digest", "size").agg(
            F.min(F.struct(page.alias("page"), "same")).alias("first"), F.sum("same").alias("n"))
        .where(F.col("n") > 1)
        .select(F.col("digest").alias("_d"), F.col("size").alias("_s"), F.col("first.page.id").alias("first_id"),
                F.col("first.same").alias("first_rows")),
        "repeated-payloads")
    joined = base.join(firsts, (F.col("digest") == F.col("_d")) & (F.col("size") == F.col("_s")), "left")
    is_first = F.col("first_rows").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    judged = joined.withColumn("revisit", ~is_first)
    if firsts.where(F.col("first_rows") > 1).limit(1).count():
        # repeated rows of a response: all but one of them are revisits as well
        tied = ~F.col("revisit") & (F.col("first_rows") > 1)
        nr = F.row_number().over(Window.partitionBy("digest", "size").orderBy("url"))
        judged = (judged.where(~F.coalesce(tied, F.lit(False)))
                  .unionByName(judged.where(tied).withColumn("revisit", nr > 1)))
    return judged.select("page_id", "url", "payload", "digest",
                         F.when(F.col("revisit"), F.col("first_id")).alias("refers_to"), "revisit")


def write_archives(records: DataFrame, folder: str, scratch: Scratch, dictionary: bytes) -> DataFrame:
    """One archive per task; rows: path, records."""

    def write(batches):
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        count = 0

        def built():
            nonlocal count
            for batch in itertools.chain([first], batches):
                for at in range(0, batch.num_rows, 500):
                    for r in batch.slice(at, 500).to_pylist():
                        count += 1
                        yield record(r["page_id"], r["url"], r["payload"], base32_digest(r["digest"]), r["refers_to"], r["revisit"])

        with files.create(folder, "pages", ".warc.zst") as (path, out):
            write_archive(out, built(), dictionary)
        yield pa.record_batch([[path], [count]], ["path", "records"])

    return scratch.write(records.mapInArrow(write, "path string, records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def one(headers, block):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rsplit(b"Content-Length: ", 1)[1])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = headers["WARC-Type"]
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest or size != len(payload):
                raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not the one that was written")
        number = lambda key: int(headers[key]) if key in headers else None
        return number("X-Page-Id"), size, digest, kind, number("X-Refers-To-Page-Id")

    def read(batches):
        types = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with files.open_input(path) as file:
                    for headers, block in read_archive(file):
                        rows.append(one(headers, block))
                        if len(rows) == 2000:
                            yield pa.record_batch([list(c) for c in zip(*rows)], schema=types)
                            rows = []
                if rows:
                    yield pa.record_batch([list(c) for c in zip(*rows)], schema=types)

    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(read, schema)
