"""Record streams from length-prefixed binary logs.

Where record k+1 starts is only known once record k's 4-byte prefix is read, so a file is a chain.
Files are read in parallel, and so are the byte ranges of one large file:

1. Every file is cut into ranges of ``range_bytes``. A file of one range starts at byte 0.
2. For files of several ranges, a first pass works out for each range where *every* possible entry
   leaves it: chains that meet go on as one, so this is little more than one walk. Such a table is a function, so the
   tables of ``FAN`` neighbours compose to one, these again, until a file has few; from there the true entries are followed
   down again, ``FAN`` tables at a time. Nothing is guessed, no task goes through more than ``FAN`` tables of a file, and the
   number of jobs grows with the logarithm of the number of ranges only (base ``FAN``), whatever the records hold.
3. The second pass reads every range from its true start and emits the records.

Only file names, sizes and one table per range (1 % of 64 MB before compression) ever leave the tasks.
"""

from __future__ import annotations

import hashlib
import struct
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.session import drop_scratch, scratch_dir
from acctlake.sources.files import locate

# The task functions travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 64 * 1024 * 1024
#: Small inputs are cut finer to keep every core busy, but below this the first pass costs more.
SMALLEST_RANGE = 16 * 1024 * 1024
#: Fixed value of the dataset: content hashes are made of blocks of this size. Ranges are whole blocks, so the
#: hash of a file does not depend on how it was cut.
HASH_BLOCK = 4 * 1024 * 1024
#: A prefix holds a 16-bit length that includes its own 4 bytes.
PREFIX, LONGEST = 4, 0xFFFF
#: Chains are compared at the end of each stretch of so many bytes.
STRETCH = 4096
#: Neighbouring tables of a file that one task composes, or follows, in order.
FAN = 128
BATCH_BYTES, BATCH_ROWS = 8 * 1024 * 1024, 65536

BAD_LENGTH, CUT_OFF, SEGMENTED = "bad length", "cut off", "segmented record"

FRAME_SCHEMA = (
    "source_file string, record_seq bigint, byte_offset bigint, body binary, error string, "
    "file_hash string"
)
SURVEY_SCHEMA = (
    "source_file string, length bigint, range_no bigint, leave binary, hash_high bigint, hash_low bigint"
)
#: ``node`` is the place of a table in its file: a range, or so many times ``FAN`` ranges.
NODE_SCHEMA = "source_file string, length bigint, node bigint, leave binary"
INDEX_SCHEMA = "source_file string, length bigint, node bigint, entry bigint, first_seq bigint"


# -- helpers that run inside tasks ---------------------------------------------------------------


def _load(path: str, start: int, end: int) -> bytes:
    """The bytes of a range plus room for the record that crosses its end."""
    filesystem, inner = locate(path)
    with filesystem.open_input_file(inner) as stream:
        return stream.read_at(end - start + LONGEST, start)


def _content_hash(data: bytes, start: int, size: int) -> tuple[int, int]:
    """Hash of a range as two signed longs; the XOR over the ranges of a file is the file's."""
    high = low = 0
    for at in range(0, size, HASH_BLOCK):
        block = hashlib.blake2b(
            data[at : min(at + HASH_BLOCK, size)],
            digest_size=16,
            salt=struct.pack(">q", start + at),
        ).digest()
        block_high, block_low = struct.unpack(">qq", block)
        high, low = high ^ block_high, low ^ block_low
    return high, low


def _stream_hash(stream, start: int, end: int) -> str:
    """Hash of a whole file, or of a range, read block by block."""
    high = low = 0
    for at in range(start, end, HASH_BLOCK):
        size = min(HASH_BLOCK, end - at)
        block_high, block_low = _content_hash(stream.read_at(size, at), at, size)
        high, low = high ^ block_high, low ^ block_low
    return _hash_text(high, low)


def _hash_text(high: int, low: int) -> str:
    return struct.pack(">qq", high, low).hex().upper()


def _walk(data: bytes, position: int, limit: int) -> tuple[list[int], int, str | None]:
    """Starts of the records from ``position`` up to ``limit``, where the walk ended, and why it
    could not go on (None: it reached the limit)."""
    starts: list[int] = []
    size = len(data)
    while position < limit:
        if position + PREFIX > size:
            return starts, position, CUT_OFF
        length = (data[position] << 8) | data[position + 1]
        if length < PREFIX:
            return starts, position, BAD_LENGTH
        if position + length > size:
            return starts, position, CUT_OFF
        starts.append(position)
        position += length
    return starts, position, None


#: Where one entry leaves a range: bytes past its end, frames up to there, whether the chain broke.
_LEAVE = np.dtype([("past", "<u2"), ("frames", "<u8"), ("broke", "u1")])


def _leaves(data: bytes, span: int) -> np.ndarray:
    """Where every entry of a range of ``span`` bytes leaves it."""
    out = np.zeros(LONGEST, _LEAVE)
    out["past"][span:] = np.arange(max(0, LONGEST - span))
    entries = min(span, LONGEST)
    size = len(data)
    counts = [0] * entries
    # By stretch, the places that chains have reached, each with the chain that came there first.
    waiting: dict[int, dict[int, int]] = {}
    for first in range(0, entries, STRETCH):
        waiting[first // STRETCH] = {p: p for p in range(first, min(first + STRETCH, entries))}
    met: list[tuple[int, int, int]] = []
    for stretch in range(span // STRETCH + 1):
        for begin, chain in waiting.pop(stretch, {}).items():
            position, frames = begin, 0
            stop = min((stretch + 1) * STRETCH, span)
            broke = False
            while position < stop:
                frames += 1
                if position + PREFIX > size:
                    broke = True
                    break
                length = (data[position] << 8) | data[position + 1]
                if length < PREFIX or position + length > size:
                    broke = True
                    break
                position += length
            counts[chain] += frames
            if broke or position >= span:
                out[chain] = (0 if broke else position - span, counts[chain], broke)
                continue
            there = waiting.setdefault(position // STRETCH, {})
            other = there.setdefault(position, chain)
            if other != chain:
                met.append((chain, other, counts[chain] - counts[other]))
    # Chains that met another: its way from there on. The last to meet comes first.
    for chain, other, ahead in reversed(met):
        past, frames, broke = out[other]
        out[chain] = (past, int(frames) + ahead, broke)
    return out


def _survey_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table of leaves and the content digest of each range."""
    for batch in batches:
        for row in batch.to_pylist():
            start = row["range_start"]
            end = min(start + row["range_bytes"], row["length"])
            data = _load(row["source_file"], start, end)
            high, low = _content_hash(data, start, end - start)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "source_file": row["source_file"],
                        "length": row["length"],
                        "range_no": row["range_no"],
                        "leave": _leaves(data, end - start).tobytes(),
                        "hash_high": high,
                        "hash_low": low,
                    }
                ],
                schema=_SURVEY_ARROW,
            )


def _after(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Where every entry of one stretch of a file leaves the next one."""
    out = then[first["past"]]
    out["frames"] += first["frames"]
    broke = first["broke"] != 0
    out[broke] = first[broke]
    return out


def _table(batch: pa.RecordBatch, row: int, column: str = "leave") -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), _LEAVE)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table for each ``FAN`` neighbours of a file; a file's tables come in order."""
    group, whole = None, None

    def made() -> pa.RecordBatch:
        columns = [pa.array([v], t) for v, t in zip((*group, whole.tobytes()), _NODE_ARROW.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=_NODE_ARROW)

    for batch in batches:
        for i in range(batch.num_rows):
            name, length, node = (batch.column(c)[i].as_py() for c in range(3))
            if (name, length, node // FAN) == group:
                whole = _after(whole, _table(batch, i))
                continue
            if group is not None:
                yield made()
            group, whole = (name, length, node // FAN), _table(batch, i)
    if group is not None:
        yield made()


def _follow(batches: Iterator[pa.RecordBatch], node_bytes: int) -> Iterator[pa.RecordBatch]:
    """True entry and first sequence number of each node that has frames.

    Each ``FAN`` neighbours come in order after a row without table, which has the entry and the sequence number of the first;
    neighbours without such a row have no frames.
    """
    group, entry, sequence, dead = None, 0, 0, True
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            name, length, node = (batch.column(c)[i].as_py() for c in range(3))
            if not batch.column(3)[i].is_valid:
                group, dead = (name, node // FAN), False
                entry, sequence = (batch.column(c)[i].as_py() for c in (4, 5))
                continue
            if dead or (name, node // FAN) != group:
                continue
            start = node * node_bytes
            end = min(start + node_bytes, length)
            past, frames, broke = _table(batch, i)[entry - start]
            if frames:
                rows.append((name, length, node, entry, sequence))
            entry, sequence, dead = end + int(past), sequence + int(frames), bool(broke)
        columns = zip(*rows, strict=True) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, _INDEX_ARROW.types, strict=True)], schema=_INDEX_ARROW
        )


_SURVEY_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("length", pa.int64()),
        ("range_no", pa.int64()),
        ("leave", pa.binary()),
        ("hash_high", pa.int64()),
        ("hash_low", pa.int64()),
    ]
)
_NODE_ARROW = pa.schema(
    [("source_file", pa.string()), ("length", pa.int64()), ("node", pa.int64()), ("leave", pa.binary())]
)
_INDEX_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("length", pa.int64()),
        ("node", pa.int64()),
        ("entry", pa.int64()),
        ("first_seq", pa.int64()),
    ]
)


def _frame_batch(row, sequence, offset, bodies, errors, file_hash) -> pa.RecordBatch:
    rows = len(bodies)
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(pa.scalar(row["source_file"]), rows),
            pa.array(np.arange(sequence, sequence + rows)),
            offset,
            bodies,
            errors,
            pa.repeat(pa.scalar(file_hash), rows),
        ],
        names=["source_file", "record_seq", "byte_offset", "body", "error", "file_hash"],
    )


def _bodies(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The records between consecutive bounds without their prefixes, for all of them at once."""
    relative = bounds - bounds[0]
    keep = np.ones(relative[-1], dtype=bool)
    keep[relative[:-1, None] + np.arange(PREFIX)] = False
    content = data[bounds[0] : bounds[-1]][keep]
    offsets = (relative - PREFIX * np.arange(len(bounds))).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(content)]
    )


def _emit_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each range, in batches of about ``BATCH_BYTES``; no more of a range is held at a time."""
    for batch in batches:
        for row in batch.to_pylist():
            position, sequence = row["entry"], row["first_seq"]
            end = min(row["range_start"] + row["range_bytes"], row["length"])
            filesystem, inner = locate(row["source_file"])
            with filesystem.open_input_file(inner) as stream:
                file_hash = row["file_hash"] or _stream_hash(stream, row["range_start"], end)
                while position < end:
                    span = min(BATCH_BYTES, end - position)
                    # Room for the record that crosses the end of the piece.
                    data = stream.read_at(span + LONGEST, position)
                    starts, stop, error = _walk(data, 0, span)
                    octets = np.frombuffer(data, dtype=np.uint8)
                    bounds = np.array([*starts, stop], dtype=np.int64)
                    for first in range(0, len(starts), BATCH_ROWS):
                        last = min(first + BATCH_ROWS, len(starts))
                        at = bounds[first:last]
                        segmented = (octets[at + 2] | octets[at + 3]) != 0
                        yield _frame_batch(
                            row,
                            sequence,
                            pa.array(at + position),
                            _bodies(octets, bounds[first : last + 1]),
                            pc.if_else(pa.array(segmented), SEGMENTED, pa.scalar(None, pa.string())),
                            file_hash,
                        )
                        sequence += last - first
                    position += stop
                    if error is not None:
                        yield _frame_batch(
                            row,
                            sequence,
                            pa.array([position], pa.int64()),
                            pa.array([None], pa.binary()),
                            pa.array([error], pa.string()),
                            file_hash,
                        )
                        break


# -- plans ---------------------------------------------------------------------------------------


def list_logs(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """``source_file, length`` of every file under the paths; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select(F.col("path").alias("source_file"), "length")


def _spread(ranges: DataFrame, tasks: int) -> DataFrame:
    # Dealt out evenly, to an explicit number: range rows are tiny, so size-based coalescing would
    # put all of them into one task.
    return ranges.repartition(max(1, tasks))


def _neighbours(nodes: DataFrame, tasks: int, *first: str) -> DataFrame:
    """Each ``FAN`` neighbours of a file in one task, in order; several such groups come one after the other."""
    group = F.expr(f"node div {FAN}")
    return nodes.repartition(tasks, "source_file", group).sortWithinPartitions("source_file", group, *first, "node")


def _range_index(spark: SparkSession, large: DataFrame, range_bytes: int, tasks: int, longest: int,
                 size: int) -> DataFrame:
    """True entry, first sequence number and content digest for every range of the large files, of which ``longest`` bytes
    are the longest and all together have at most ``size``."""
    ranges = (
        large.select(
            "*",
            F.explode(
                F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {range_bytes}"))
            ).alias("range_no"),
        )
        .withColumn("range_bytes", F.lit(range_bytes).cast("long"))
        .withColumn("range_start", F.col("range_no") * F.col("range_bytes"))
    )
    surveyed, index = scratch_dir(spark, "survey"), scratch_dir(spark, "ranges")
    _spread(ranges, tasks).mapInArrow(_survey_ranges, SURVEY_SCHEMA).write.parquet(surveyed)
    survey = spark.read.schema(SURVEY_SCHEMA).parquet(surveyed)
    hashes = survey.groupBy("source_file").agg(
        F.concat(
            F.lpad(F.hex(F.bit_xor("hash_high")), 16, "0"),
            F.lpad(F.hex(F.bit_xor("hash_low")), 16, "0"),
        ).alias("file_hash")
    )
    # Up: tables of FAN neighbours are composed until no file has more than FAN. Each level is read twice, so it is written.
    nodes = [survey.select("source_file", "length", F.col("range_no").alias("node"), "leave")]
    scratch, step = [surveyed], range_bytes

    def groups(node_bytes: int) -> int:
        return size // (node_bytes * FAN) + 1

    while -(-longest // step) > FAN:
        scratch.append(scratch_dir(spark, "composed"))
        composed = _neighbours(nodes[-1], groups(step)).mapInArrow(_compose, NODE_SCHEMA)
        composed.write.parquet(scratch[-1])
        nodes.append(spark.read.schema(NODE_SCHEMA).parquet(scratch[-1]))
        step *= FAN
    # Down: what is known of a group is where its first node is entered; for a whole file, at its first byte.
    none = F.lit(None)
    zero = F.lit(0).cast("long")
    known = large.select("source_file", "length", zero.alias("node"), zero.alias("entry"), zero.alias("first_seq"))
    for level in reversed(nodes):
        entered = known.select("source_file", "length", (F.col("node") * FAN).alias("node"),
                               none.cast("binary").alias("leave"), "entry", "first_seq")
        both = level.select("*", none.cast("long").alias("entry"), none.cast("long").alias("first_seq")).unionByName(entered)
        both = both.withColumn("is_table", F.col("leave").isNotNull())
        known = _neighbours(both, groups(step), "is_table").mapInArrow(partial(_follow, node_bytes=step), INDEX_SCHEMA)
        step //= FAN
    entries = known.withColumnRenamed("node", "range_no")
    entries.join(hashes, "source_file").write.parquet(index)
    for path in scratch:
        drop_scratch(spark, path)
    stored = "source_file string, length bigint, range_no bigint, entry bigint, first_seq bigint, file_hash string"
    return spark.read.schema(stored).parquet(index)


def split_files(files: DataFrame, range_bytes: int | None = None) -> DataFrame:
    """Framed records of the listed files.

    Columns: ``source_file, record_seq, byte_offset, body, error, file_hash``. ``error`` is set on
    damaged frames: a bad length or a record that runs past the end of its file ends that file
    with one such row (no body); a segmented record is marked and the walk goes on.

    ``range_bytes`` is 64 MB, down to 16 MB where the whole input would not keep every core busy.
    Other values must be whole blocks of ``HASH_BLOCK`` bytes.
    """
    if range_bytes is not None and (range_bytes <= 0 or range_bytes % HASH_BLOCK):
        raise ValueError(f"range_bytes must be a multiple of {HASH_BLOCK}")
    spark = files.sparkSession
    files = files.where("length > 0")
    # Only three numbers come back to the driver: they size the tasks.
    sizes = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.max("length"), F.lit(0)).alias("longest"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    ).first()
    parallel = spark.sparkContext.defaultParallelism
    if range_bytes is None:
        share = -(-sizes["bytes"] // (2 * parallel * HASH_BLOCK)) * HASH_BLOCK
        range_bytes = min(RANGE_BYTES, max(SMALLEST_RANGE, share))
    by_size = sizes["bytes"] // range_bytes + 1
    tasks = int(min(sizes["files"] + by_size, max(parallel, by_size)))

    small = files.where(F.col("length") <= range_bytes).select(
        "source_file",
        "length",
        F.lit(0).cast("long").alias("range_no"),
        F.lit(0).cast("long").alias("entry"),
        F.lit(0).cast("long").alias("first_seq"),
        F.lit(None).cast("string").alias("file_hash"),
    )
    ranges = small
    if sizes["longest"] > range_bytes:
        large = files.where(F.col("length") > range_bytes)
        index = _range_index(spark, large, range_bytes, tasks, sizes["longest"], sizes["bytes"])
        ranges = small.unionByName(index.select(*small.columns))
    located = (
        ranges.withColumn("range_bytes", F.lit(range_bytes).cast("long"))
        .withColumn("range_start", F.col("range_no") * F.col("range_bytes"))
    )
    return _spread(located, tasks).mapInArrow(_emit_frames, FRAME_SCHEMA)


def read_records(spark: SparkSession, paths: str | list[str], glob: str | None = None,
                 range_bytes: int | None = None) -> DataFrame:
    """Framed records of all logs under the paths (see :func:`split_files`)."""
    return split_files(list_logs(spark, paths, glob), range_bytes)
