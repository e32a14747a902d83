"""WARC archives with an index: written per task, read back by coalesced byte ranges.

``write_archives`` writes one gzip member per record and returns an index row with file, offset, length,
URL and digest. ``read_records`` takes any selection of index rows, sorts their ranges within each
stretch of a file, joins ranges that lie close together into one read and returns the records. Only index
rows are shuffled, never payloads; a file is read in stretches, so one large file is many tasks.

A page's record is a ``response`` or, if an equal payload of ``min_revisit_bytes`` or more has a smaller
page id, a ``revisit`` that names it. Equality is that of SHA-256.

Lost executors. Every attempt writes files of its own name and the index only names files of attempts
that succeeded; the index is a written table. A read is repeated from files in the shared folder.

Defined results. NULL html is an empty payload; an empty table gives no records. Rows with equal payload and the same, smallest
page id are all responses. A NULL page id never becomes the response of others, and such rows are
responses. Any URL can be written: control characters are percent-encoded in the header, the index keeps the
original (NULL stays NULL). Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import ship, stage
from acctlake.session import scratch_dir
from acctlake.sources.files import locate

#: Payloads below this size are always stored in full.
MIN_REVISIT_BYTES = 100
#: A writer starts a new file beyond this size.
FILE_BYTES = 1 << 30
#: Ranges of one task lie in the same stretch of a file.
STRETCH_BYTES = 32 << 20
#: Ranges with at most this gap become one read, up to this size (a longer record is one read of its own).
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Every record has the same date, so archives are equal from run to run.
DATE = "2020-01-01T00:00:00Z"

INDEX = (
    "page_id long, url string, file string, offset long, length long, payload_digest string,"
    " payload_bytes long, record_type string, refers_to long"
)
RECORD = (
    "page_id long, record_type string, refers_to long, header_digest string,"
    " block_bytes long, block_digest string"
)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html`` with ``payload_digest, payload_bytes, refers_to`` (NULL for responses)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    # Only digests that occur under several ids matter, and of these only the later ids.
    digests = pages.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest")
    first = (
        digests.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where("refers_to < last")
        .drop("last")
    )
    # One page id may come with several payloads: the digest is part of the key.
    later = digests.distinct().join(first, "payload_digest").where("page_id > refers_to")
    later = later.select(F.col("page_id").alias("later_id"), F.col("payload_digest").alias("later_digest"), "refers_to")
    return pages.join(
        later,
        (F.col("page_id") == F.col("later_id")) & (F.col("payload_digest") == F.col("later_digest")),
        "left",
    ).drop("later_id", "later_digest")


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Write the records of ``plan_records`` under ``folder``; the index as a written table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = locate(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is not None and at >= FILE_BYTES:
                        out.close()
                        out = None
                    if out is None:
                        filesystem.create_dir(inner, recursive=True)
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = filesystem.open_output_stream(f"{inner}/{name}", compression=None)
                    member = gzip.compress(record_bytes(row), 6, mtime=0)
                    out.write(member)
                    rows.append({
                        **{k: row[k] for k in ("page_id", "url", "payload_digest", "payload_bytes", "refers_to")},
                        "record_type": "response" if row["refers_to"] is None else "revisit",
                        "file": name, "offset": at, "length": len(member),
                    })
                    at += len(member)
                yield pa.RecordBatch.from_pylist(rows, INDEX_ARROW)
        finally:
            if out is not None:
                out.close()

    return stage(planned.mapInArrow(write, INDEX), "warc-index")


def record_bytes(row: dict) -> bytes:
    """One WARC 1.1 record. A revisit has an empty block and the payload's digest in its header."""
    payload = row["html"].encode("utf-8")
    revisit = row["refers_to"] is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(row['page_id'], row['payload_digest'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe=SAFE)}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Page-Id: {'' if row['page_id'] is None else row['page_id']}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(row['refers_to'], row['payload_digest'])}",
            f"X-Refers-To-Page-Id: {row['refers_to']}",
        ]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + payload + b"\r\n\r\n"


#: Characters of a URL that go into a header as they are.
SAFE = "!#$%&'()*+,/:;=?@[]~^{}|`\\\"<>"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block; raises ValueError on a damaged record."""
    data = gzip.decompress(member)
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not mark or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not match its header")
    return fields, rest[:size]


def coalesced(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Join sorted (offset, length) ranges: start, end, and the ranges within."""
    group: list[tuple[int, int]] = []
    end = 0
    for offset, length in ranges:
        if group and (offset - end > GAP_BYTES or offset + length - group[0][0] > READ_BYTES):
            yield group[0][0], end, group
            group = []
        group.append((offset, length))
        end = max(end, offset + length) if len(group) > 1 else offset + length
    if group:
        yield group[0][0], end, group


def read_records(selected: DataFrame, folder: str, blocks: bool = False) -> DataFrame:
    """The records of the selected index rows: header fields, size and digest of the block that was read.

    ``blocks=True`` adds the block itself as ``block binary``.
    """
    stretches = (
        selected.select("file", "offset", "length", F.floor(F.col("offset") / STRETCH_BYTES).alias("stretch"))
        .repartition("file", "stretch")
        .sortWithinPartitions("file", "offset")
        .select("file", "offset", "length")
    )
    schema = RECORD + (", block binary" if blocks else "")
    arrow = RECORD_ARROW.append(pa.field("block", pa.binary())) if blocks else RECORD_ARROW

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = locate(folder)
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                by_file.setdefault(file, []).append((offset, length))
            for file, ranges in by_file.items():
                with filesystem.open_input_file(f"{inner}/{file}") as source:
                    for start, end, group in coalesced(ranges):
                        data = source.read_at(end - start, start)
                        rows = []
                        for offset, length in group:
                            fields, block = parse_record(data[offset - start : offset - start + length])
                            row = {
                                "page_id": int(fields["x-page-id"]) if fields["x-page-id"] else None,
                                "record_type": fields["warc-type"],
                                "refers_to": int(fields["x-refers-to-page-id"]) if "x-refers-to-page-id" in fields else None,
                                "header_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
                                "block_bytes": len(block),
                                "block_digest": hashlib.sha256(block).hexdigest(),
                            }
                            rows.append({**row, "block": block} if blocks else row)
                        yield pa.RecordBatch.from_pylist(rows, arrow)

    return stretches.mapInArrow(read, schema)


def resolve(records: DataFrame) -> DataFrame:
    """Size and digest of each record's full payload; a revisit takes them from the response it names."""
    records = stage(records, "warc-read")
    responses = records.where("record_type = 'response'")
    named = records.where("refers_to is not null").select("refers_to", "header_digest").distinct()
    targets = (
        responses.select(F.col("page_id").alias("refers_to"), F.col("block_digest").alias("header_digest"), "block_bytes")
        .join(named, ["refers_to", "header_digest"], "left_semi")
        .groupBy("refers_to", "header_digest")
        .agg(F.min("block_bytes").alias("target_bytes"))
    )
    revisits = (
        records.where("record_type = 'revisit'")
        .join(targets, ["refers_to", "header_digest"], "left")
        .select("page_id", F.col("target_bytes").alias("payload_bytes"),
                F.when(F.col("target_bytes").isNotNull(), F.col("header_digest")).alias("payload_digest"),
                "record_type", "refers_to")
    )
    return responses.select(
        "page_id", F.col("block_bytes").alias("payload_bytes"), F.col("block_digest").alias("payload_digest"),
        "record_type", "refers_to",
    ).unionByName(revisits)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared scratch folder and read every record back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    index = write_archives(plan_records(pages), folder)
    return resolve(read_records(index, folder))


INDEX_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
    ("length", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])
RECORD_ARROW = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("header_digest", pa.string()), ("block_bytes", pa.int64()), ("block_digest", pa.string()),
])

ship(__name__)
