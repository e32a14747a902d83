"""Groups of near copies: all pairs of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Nothing is estimated: candidates come from prefix filtering and each is verified on the whole sets. All shingles have one global order;
if two sets are similar, the first ``n - ceil(0.8 n) + 1`` shingles of each share one. Lengths and the places of the shared shingle
rule out most other pairs. Rare shingles come first in the order: what is frequent in a bounded sample of the documents comes last, so
a common passage is a key only for documents that hold little else. The sample decides about the order and so about speed, never about the result.

Each set has a sketch, the numbers of its shingles in n / 8 to n / 4 buckets, a byte each. Two sets differ in at least as many
shingles as their sketches do, and similar sets of n and m shingles in no more than (n + m) / 9; so sketches rule out unrelated
pairs without a mistake. Only sets of pairs that are left are cut from their texts, found by the rows' places in their files.

Scale. Documents with equal sets are one node. A key that more than ``PAIR_LIMIT`` sets share is compared with its central set first; what this
leaves in different groups is compared pair by pair within sizes that can be similar, where the smaller set must have the key among its first n / 9
shingles. So a large group of near copies costs one comparison a member, and a passage in very many texts none; very many
different texts of one size that share a rare shingle still cost their pairs.

Defined results. Words are as in ``simhash``; a text of fewer words is one shingle. NULL, empty and blank texts have the empty
set and are one group. Repeated rows each get a row, and NULL ids too. Very long texts are one array of hashes each. Empty tables give no
rows; other columns are not read, and ``carried`` ones keep their names whatever they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from acctlake.llm.common import pieces, ship, stage, with_row
from acctlake.llm.components import components

SEED = 42
WIDTH = 5
#: Sets of one key that are compared pair by pair at once.
PAIR_LIMIT = 32
#: Documents that tell frequent shingles; a shingle in so many of them is frequent; the most frequent ones that are kept.
SAMPLE_DOCS, FREQUENT, MOST = 10_000, 4, 1 << 18


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the shingles of ``width`` words, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    if len(words) <= width:
        starts, ends = [0], [len(joined)]
    else:
        starts = (ends - lengths)[: len(words) - width + 1].tolist()
        ends = ends[width - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    some = np.fromiter((hashed(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)), np.uint64, len(starts))
    return np.unique(some.view(np.int64))


def set_id(hashes: np.ndarray) -> int:
    """64 bits that stand for a set; 0 for the empty one."""
    if not len(hashes):
        return 0
    value = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def prefix(hashes: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles in the global order, of which similar sets share one; frequent ones come last."""
    n = len(hashes)
    if not n:
        return hashes
    rank = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rank = np.where(frequent[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, rank))][: n - (4 * n + 4) // 5 + 1]


def _frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent shingles and their counts in the sample."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text, width))], ["shingle"])

    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    sample = docs.where(F.xxhash64(F.lit(SEED), "text").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30)))
    counted = (
        sample.distinct().mapInArrow(each, "shingle long").groupBy("shingle").count().where(F.col("count") >= FREQUENT)
        .orderBy(F.desc("count"), "shingle").limit(MOST).toPandas().sort_values("shingle")
    )
    return counted["shingle"].to_numpy(np.int64), counted["count"].to_numpy(np.int64)


def sketch(hashes: np.ndarray) -> bytes:
    """How many shingles fall into each bucket, 255 for that many or more; the buckets are the lowest bits of the hashes."""
    buckets = 1 << max(3, (len(hashes) // 8).bit_length())
    return np.minimum(np.bincount(hashes & (buckets - 1), minlength=buckets), 255).astype(np.uint8).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A number of shingles that two sets differ in at least; 0 if a bucket is too full to tell."""
    x, y = (np.frombuffer(s, np.uint8) for s in (a, b))
    if x.max(initial=0) == 255 or y.max(initial=0) == 255:
        return 0
    size = min(len(x), len(y))
    # The lowest bits of more buckets, added up, are those of fewer.
    x, y = (s.reshape(-1, size).sum(axis=0, dtype=np.int64) for s in (x, y))
    return int(np.abs(x - y).sum())


def _similar(pairs: DataFrame, found: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs ``a, b`` of set ids whose sets are similar; ``found`` has ``id, n, sketch, row`` of every document."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
            left = [9 * least_difference(p, q) <= i + j for i, j, p, q in zip(n, m, x, y, strict=True)]
            kept = batch.filter(pa.array(left, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(i) for i in (0, 1, 6, 7)], ["a", "b", "row_a", "row_b"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                sets = pa.array([shingles(batch.column(1)[n].as_py(), width)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(n, 1), sets], ["id", "hashes"])

    pairs = stage(pairs.distinct(), "pairs")
    if pairs.isEmpty():
        return pairs
    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    known = found.select("id", "n", "sketch", "row").join(wanted, "id", "left_semi")
    known = stage(known.dropDuplicates(["id"]), "sketches")
    sides = [known.select(*[F.col(c).alias(f"{c}_{side}") for c in known.columns]) for side in "ab"]
    both = pairs.join(sides[0], F.col("a") == F.col("id_a")).join(sides[1], F.col("b") == F.col("id_b"))
    row = "struct<file: bigint, at: bigint>"
    left = stage(
        both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "row_a", "row_b")
        .mapInArrow(close, f"a long, b long, row_a {row}, row_b {row}"),
        "close",
    )
    # A written table of known size: the rows of few sets are sent to the texts.
    rows = stage(
        left.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("row_a").alias("row")),
                                      F.struct(F.col("b").alias("id"), F.col("row_b").alias("row")))).alias("s"))
        .select("s.id", F.col("s.row.file").alias("file"), F.col("s.row.at").alias("at")).distinct(),
        "rows-of-sets",
    )
    at = (F.col("row.file") == F.col("file")) & (F.col("row.at") == F.col("at"))
    sets = stage(texts.join(rows, at).select("id", "text").mapInArrow(cut, "id long, hashes array<long>"), "sets")
    verified = (
        left.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b")
    )
    # Jaccard >= 0.8, without division.
    similar = 9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))
    return verified.where(similar).select("a", "b")


def _possible(n: Column, m: Column, i: Column, j: Column) -> Column:
    """Whether sets of n and m shingles can be similar if the first one they share is the i-th and j-th."""
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * F.least(n - i, m - j) >= 4 * (n + m))


def _size_class(n: Column) -> Column:
    """Grows with the size; a set's size and 1.25 times as much are about one class apart."""
    return F.floor(F.ln(n.cast("double")) / math.log(1.25))


def links(found: DataFrame, texts: DataFrame, width: int = WIDTH, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links ``a, b`` that connect exactly what similar pairs connect.

    ``found`` has ``id, n, prefix, sketch, row`` of every document, ``texts`` its ``row, text``.
    """
    keyed = found.select("id", "n", F.posexplode("prefix").alias("at", "key"))
    # Most keys stand alone: only the others are kept, as a written table of known size.
    repeated = stage(keyed.groupBy("key").count().where("count > 1").select("key"), "repeated-keys")
    met = stage(keyed.join(repeated, "key").distinct(), "met")
    sizes = met.groupBy("key").agg(F.count("*").alias("members"))
    shared = stage(met.join(stage(sizes.where("members > 1"), "sizes"), "key"), "shared-keys")
    few = shared.where(F.col("members") <= pair_limit).select("key", "id", "n", "at")
    many = shared.where(F.col("members") > pair_limit).drop("members")
    # The set with the most crowded keys has least of its own: of near copies it is the one that most others are similar to.
    crowded = stage(many.groupBy("id").agg(F.count("*").alias("crowded")), "crowded")
    centres = many.join(crowded, "id").groupBy("key").agg(F.max(F.struct("crowded", "id", "n", "at")).alias("centre"))
    many = stage(many.join(stage(centres, "centres"), "key"), "crowded-keys")

    def paired(rows: DataFrame, others: DataFrame) -> DataFrame:
        """Pairs of one key: the smaller set has it among its first n / 9 shingles, the larger one has up to 1.25 times its size."""
        smaller = rows.where(9 * (F.col("n") - F.col("at")) >= 8 * F.col("n")).withColumn(
            "class", F.explode(F.sequence(_size_class(F.col("n")), _size_class(F.col("n") * 1.25)))
        )
        right = others.select("key", _size_class(F.col("n")).alias("class"), *[
            F.col(c).alias(f"{c}_") for c in others.columns if c != "key"
        ])
        # Of equal sizes the smaller id counts as the smaller set, so a pair is made once.
        both = smaller.join(right, ["key", "class"]).where(F.struct("n", "id") < F.struct(F.col("n_"), F.col("id_")))
        if "root" in rows.columns:
            both = both.where("root <> root_").where(~F.arrays_overlap("earlier", "earlier_"))
        return both.where(_possible(F.col("n"), F.col("n_"), F.col("at"), F.col("at_"))).select(
            F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")
        )

    stars = many.where("id <> centre.id").where(
        _possible(F.col("n"), F.col("centre.n"), F.col("at"), F.col("centre.at"))
    ).select(F.least("id", "centre.id").alias("a"), F.greatest("id", "centre.id").alias("b"))
    linked = stage(_similar(paired(few, few).unionByName(stars), found, texts, width), "similar")
    # What is still apart in a key of many sets: all its pairs.
    roots = components(linked)
    rooted = many.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n", "at", F.coalesce("root", "id").alias("root"), F.col("centre.id").alias("first")
    )
    first = rooted.where("id = first").select("key", F.col("root").alias("main"))
    # A pair is made at the first crowded key that both sets have, not at each.
    keys = rooted.groupBy("id").agg(F.collect_list(F.struct("at", "key")).alias("keys"))
    rooted = rooted.drop("first").join(first, "key").join(stage(keys, "keys-of-sets"), "id").withColumn(
        "earlier", F.transform(F.filter("keys", lambda k: k["at"] < F.col("at")), lambda k: k["key"])
    )
    rooted = stage(rooted.drop("keys"), "apart")
    rest, main = rooted.where("root <> main").drop("main"), rooted.where("root = main").drop("main")
    # Either side of a pair may be the one outside the main group.
    apart = paired(rest, rooted.drop("main")).unionByName(paired(main, rest))
    return linked.unionByName(_similar(apart, found, texts, width))


def near_copies(
    docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, component`` (a number for the group) of every row, and the ``carried`` columns."""
    numbered = with_row(docs, "row__set")
    text_ = F.col(text).cast("string").alias("text__set")
    frequent, counts = _frequent(numbered.select(text_.alias("text")), width)
    place = 2 + len(carried)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, place):
            sets = [shingles(t, width) for t in batch.column(place).to_pylist()]
            arrays = [
                pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([prefix(s, frequent, counts) for s in sets], pa.list_(pa.int64())),
                pa.array([sketch(s) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*batch.schema.names[:-1], *ADDED])

    kept = numbered.select(F.col(doc_id).cast("long").alias("doc_id"), *carried, "row__set", text_)
    schema = StructType([
        *kept.schema.fields[:-1],
        *[StructField(c, t) for c, t in zip(ADDED, (LongType(), IntegerType(), ArrayType(LongType()), BinaryType()), strict=True)],
    ])
    found = stage(kept.mapInArrow(each, schema), "prefixes")
    plain = found.select(*[F.col(c).alias(c.removesuffix("__set")) for c in (*ADDED, "row__set")])
    texts = numbered.select(F.col("row__set").alias("row"), text_.alias("text"))
    roots = components(links(plain, texts, width)).select(F.col("node").alias("id__set"), "root")
    joined = found.select("doc_id", *carried, "id__set").join(roots, "id__set", "left")
    return joined.select("doc_id", F.coalesce("root", "id__set").alias("component"), *carried)


#: Columns of a document's set.
ADDED = ("id__set", "n__set", "prefix__set", "sketch__set")

ship(__name__)
