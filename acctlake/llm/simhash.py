"""Near-duplicate documents by SimHash, with pigeonring filtering of the candidate pairs.

A 64-bit fingerprint is cut into a ring of ``segments`` equal parts. If two fingerprints differ in at most
``distance`` bits, there is a part from which every chain of l parts differs in at most
l * distance / segments bits. Chains whose budget is below one bit must therefore be equal: the longest of
these, taken at each starting part, is the join key. The longer chains are tested on the joined pairs, and
the full Hamming distance last.

Scale. Documents with equal fingerprints are one node, so exact copies make no pairs. Only keys that
several fingerprints share are joined. A key shared by more than ``pair_limit`` fingerprints is not paired at all:
its fingerprints are linked through the points at most one bit away (two fingerprints within two bits share
such a point; for other distances: all keys are paired). That is exact too, makes 65 rows a fingerprint whatever the size of the
group, and no more than 65 fingerprints meet in a point. Nothing is collected.

Defined results. NULL, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows
each get a row with the same values. A NULL doc_id is carried; a component's id is its smallest doc_id that
is not NULL, NULL if there is none. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from acctlake.llm.common import pieces, ship, stage
from acctlake.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints of one key that are still compared pair by pair.
PAIR_LIMIT = 64
#: Shingle hashes whose bits are counted at a time; bounds memory for very long texts.
BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the shingles of ``width`` words, A-Z in lower case; as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    if len(words) <= width:
        starts, ends = [0], [len(joined)]
    else:
        starts = (ends - lengths)[: len(words) - width + 1].tolist()
        ends = ends[width - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        some = [hashed(joined[s:e], SEED) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)]
        bits = np.unpackbits(np.array(some, ">u8").view(np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * ones > len(starts)).astype(np.uint8))
    return int(packed.view(">i8")[0])


def fingerprints(
    docs: DataFrame, width: int = 3, doc_id: str = "doc_id", text: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, fp`` of every row, and the ``carried`` columns."""
    place = 1 + len(carried)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, place):
            texts = batch.column(place).to_pylist()
            found = pa.array([fingerprint(t, width) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], found], [*batch.schema.names[:-1], "fp"]
            )

    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *carried, F.col(text).cast("string").alias("fp"))
    schema = StructType([*kept.schema.fields[:-1], StructField("fp", LongType())])
    return kept.mapInArrow(each, schema)


def _turned(fp: Column, bits: int) -> Column:
    """The ring turned left by ``bits``."""
    if not bits:
        return fp
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, BITS - bits))


def links(distinct: DataFrame, distance: int = 2, segments: int = 16, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links ``a, b`` that connect exactly what pairs within ``distance`` bits connect; from distinct ``fp``."""
    width = BITS // segments
    # The longest chain whose budget is below one bit.
    exact = max(l for l in range(1, segments + 1) if l * distance // segments == 0)
    keyed = distinct.select(
        F.posexplode(F.array(*[_turned(F.col("fp"), s * width) for s in range(segments)])).alias("start", "ring")
    ).withColumn("key", F.shiftrightunsigned("ring", BITS - exact * width))
    keyed = stage(keyed, "keys")
    shared = keyed.groupBy("start", "key").agg(F.count("*").alias("members")).where("members > 1")
    keyed = stage(keyed.join(shared, ["start", "key"]), "shared-keys")

    few = keyed if distance != 2 else keyed.where(F.col("members") <= pair_limit)
    left = few.select("start", "key", F.col("ring").alias("x"))
    right = few.select("start", "key", F.col("ring").alias("y"))
    differ = F.col("x").bitwiseXOR(F.col("y"))
    chain = F.lit(True)
    for l in range(exact + 1, segments + 1):
        chain &= F.bit_count(F.shiftrightunsigned(differ, BITS - l * width)) <= l * distance // segments
    paired = (
        left.join(right, ["start", "key"])
        .where((F.col("x") < F.col("y")) & chain)
        .select(_unturned("x", width, segments).alias("a"), _unturned("y", width, segments).alias("b"))
    )
    if distance != 2:
        return paired.distinct()
    many = keyed.where(F.col("members") > pair_limit)
    crowded = many.select(_unturned("ring", width, segments).alias("fp")).distinct()
    return paired.unionByName(_links_by_points(crowded))


def _unturned(ring: str, width: int, segments: int) -> Column:
    """The fingerprint of a ring that was turned by ``start`` segments."""
    return F.coalesce(*[
        F.when(F.col("start") == s, _turned(F.col(ring), (BITS - s * width) % BITS)) for s in range(segments)
    ])


def _links_by_points(crowded: DataFrame) -> DataFrame:
    """Each fingerprint with the smallest one that shares a point at most one bit away."""
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)]
    points = crowded.select("fp", F.explode(F.array(*flips)).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    return (
        points.join(least.drop("most"), "point")
        .where("fp <> least")
        .select(F.col("fp").alias("a"), F.col("least").alias("b"))
    )


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def near_duplicates(
    docs: DataFrame, width: int = 3, distance: int = 2, segments: int = 16,
    doc_id: str = "doc_id", text: str = "text", carried: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row, ``component`` (a number for the group) and the ``carried`` columns."""
    found = stage(fingerprints(docs, width, doc_id, text, carried), "fingerprints")
    nodes = stage(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), distance, segments)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(ids, "root").select("fp", "component_id", F.col("root").alias("component"))
    return found.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component", *carried
    )


ship(__name__)
