"""Benchmark passages in training documents, found by spaced-seed hashing.

A mask looks at some positions of a stretch of words and ignores the others. Hashes of all masks at all places
of the benchmark and of the documents are joined; around each hit the words are compared one by one along the
same diagonal, and substitutions are tolerated.

What is found, exactly: an item of n words is in a document if ``min(WINDOW, n)`` consecutive words of the
item agree with as many consecutive words of the document in at least ``SIMILARITY`` of the places. The
masks are chosen so that each window with so few substitutions holds at least one hit (tests
enumerate all of them), so this is what a comparison at all places finds, too. Items of fewer than
``SHORTEST`` words are no evidence and never match.

Scale. Documents are read once. A bit table of the benchmark's hashes, of a bounded size, keeps nearly
all places of the documents from being shuffled; it has no false negatives, and if the benchmark is very large it lets more
through but loses nothing. Only places that hit and the words next to them are written and joined. Neither
table is broadcast by force. A passage in a third of all documents is a skewed join key, which adaptive
execution splits.

Defined results. Words are runs of letters, digits and underscores in lower case; all else only separates words. NULL and empty texts
have none. Repeated documents or items each count as one. NULL ids are carried. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import pieces, scratch_scope, ship, stage, with_key

#: Words of a window, and the share of them that must agree.
WINDOW = 13
SIMILARITY = 0.8
#: Items with fewer words never match.
SHORTEST = 5
#: Positions that a mask looks at. Any two substitutions in 13 words leave one of LONG whole;
#: SHORT does the same for whole items of 5 to 12 words at their own number of substitutions.
LONG_MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SHORT_MASKS = ((0, 1, 2, 4), (0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4))
MASKS = LONG_MASKS + SHORT_MASKS
#: Words kept on either side of a hit: a window that holds the hit lies within.
CONTEXT = WINDOW + 8
#: Bits of the table of benchmark hashes: 256 for each hash, between these powers of two.
BITS_PER_HASH, BIT_POWERS = 256, (16, 26)
#: Word hashes that a task remembers.
REMEMBERED = 500_000

FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    np.uint64,
)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def tokens(text: str | None, words: dict) -> np.ndarray:
    """A 64-bit number for each word."""
    found = re.findall(r"\w+", (text or "").lower())
    return np.fromiter(map(words.__getitem__, found), np.uint64, len(found))


def seeds(ids: np.ndarray, masks: range) -> Iterator[tuple[int, np.ndarray]]:
    """Per mask its number and the hash at each place where it fits."""
    scaled = [ids * f for f in FACTORS]
    for m in masks:
        mask = MASKS[m]
        places = len(ids) - mask[-1]
        if places <= 0:
            continue
        mixed = np.full(places, m + 1, np.uint64)
        for j, offset in enumerate(mask):
            mixed += scaled[j][offset : offset + places]
        mixed ^= mixed >> np.uint64(32)
        mixed *= FACTORS[1]
        mixed ^= mixed >> np.uint64(29)
        yield m, mixed


def masks_for(n: int) -> range:
    """The masks of an item of ``n`` words."""
    if n < SHORTEST:
        return range(0)
    return range(len(LONG_MASKS)) if n >= WINDOW else range(len(LONG_MASKS), len(MASKS))


def item_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``uid, item_id, words``: one row per item."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            ids = [tokens(t, words).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], ["item_id", "words"])

    kept = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    items = kept.distinct().mapInArrow(each, "item_id long, words array<long>")
    return stage(items.withColumn("uid", F.monotonically_increasing_id()), "items")


def item_seeds(items: DataFrame) -> DataFrame:
    """``uid, place, mask, hash`` of every place of every item."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for m, hashes in seeds(np.array(words, np.int64).view(np.uint64), masks_for(len(words))):
                    n = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, uid)), pa.array(np.arange(n, dtype=np.int32)),
                         pa.array(np.full(n, m, np.int32)), pa.array(hashes.view(np.int64))],
                        ["uid", "place", "mask", "hash"],
                    )

    found = items.select("uid", "words").mapInArrow(each, "uid long, place int, mask int, hash long")
    return stage(found, "item-seeds")


def bit_table(item_seeds: DataFrame) -> tuple[int, np.ndarray]:
    """Two numbers of each hash, its low bits and those above bit 32, as a set: their bits, and the table as bytes."""
    count = item_seeds.count()
    power = min(max(math.ceil(math.log2(BITS_PER_HASH * max(1, count))), BIT_POWERS[0]), BIT_POWERS[1])
    low = F.lit((1 << power) - 1)
    probes = F.array(F.col("hash").bitwiseAND(low), F.shiftrightunsigned("hash", 32).bitwiseAND(low))
    # At most 2 ** 20 rows of two numbers, whatever the size of the benchmark.
    packed = (
        item_seeds.select(F.explode(probes).alias("at"))
        .select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    table = np.zeros((1 << power) // 64, np.int64)
    table[packed["word"].to_numpy(np.int64)] = packed["bits"].to_numpy(np.int64)
    return power, table.view(np.uint8)


def hit_clusters(docs: DataFrame, item_seeds: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ka, kb, start, words, hits, cid``: stretches of documents whose hashes are in the bit table."""
    power, table = bit_table(item_seeds)
    used = sorted(r["mask"] for r in item_seeds.select("mask").distinct().collect())
    low = np.uint64((1 << power) - 1)

    def is_set(at: np.ndarray) -> np.ndarray:
        # Bit k of a little-endian 64-bit word is bit k % 8 of its byte k // 8.
        return table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1

    def hits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places, masks, values = [], [], []
        for m, hashes in seeds(ids, used):
            hit = np.flatnonzero(is_set(hashes & low))
            hit = hit[is_set(hashes[hit] >> np.uint64(32) & low) != 0]
            places.append(hit)
            masks.append(np.full(len(hit), m))
            values.append(hashes[hit])
        if not places:
            return (np.zeros(0, np.int64),) * 3
        place, mask, value = map(np.concatenate, (places, masks, values))
        order = np.argsort(place, kind="stable")
        return place[order], mask[order], value[order]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in pieces(batches, 3):
            rows = []
            for d, ka, kb, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = tokens(content, words)
                place, mask, value = hits(ids)
                if not len(place):
                    continue
                for part in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place) > CONTEXT) + 1):
                    start = max(0, int(place[part[0]]) - CONTEXT)
                    end = int(place[part[-1]]) + CONTEXT
                    rows.append({
                        "doc_id": d, "ka": ka, "kb": kb, "start": start, "words": ids[start:end].view(np.int64),
                        "hits": [
                            {"at": int(p) - start, "mask": int(m), "hash": int(v)}
                            for p, m, v in zip(place[part], mask[part], value[part].view(np.int64), strict=True)
                        ],
                    })
            yield pa.RecordBatch.from_pylist(rows, CLUSTER_ARROW)

    key = with_key(doc_id, text)
    kept = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), key["a"].alias("ka"), key["b"].alias("kb"),
        F.col(text).cast("string").alias("text"),
    )
    found = kept.mapInArrow(each, CLUSTER)
    return stage(found.withColumn("cid", F.monotonically_increasing_id()), "clusters")


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int, int]:
    """First word in the item, first word in the document, words and agreeing words of all matching windows
    along a diagonal (document place minus item place); zeros if there is none."""
    first = max(0, -diagonal)
    last = min(len(item), len(doc) - diagonal)
    width = min(WINDOW, len(item))
    if last - first < width or width < SHORTEST:
        return 0, 0, 0, 0
    same = item[first:last] == doc[first + diagonal : last + diagonal]
    sums = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(sums[width:] - sums[:-width] >= math.ceil(SIMILARITY * width))
    if not len(good):
        return 0, 0, 0, 0
    covered = np.zeros(len(same), bool)
    for at in good:
        covered[at : at + width] = True
    return first + int(good[0]), first + diagonal + int(good[0]), int(covered.sum()), int((same & covered).sum())


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and item that it holds: ``doc_id, item_id, doc_start`` (words), ``overlap_words,
    matched_words``; of several places that with the most agreeing words. ``ka, kb`` tell apart documents of one doc_id."""
    items = item_table(benchmark, item_id, item_text)
    of_items = item_seeds(items)
    clusters = hit_clusters(docs, of_items, doc_id, text)
    candidates = (
        clusters.select("cid", F.inline("hits"))
        .join(of_items, ["mask", "hash"])
        .select("cid", "uid", (F.col("at") - F.col("place")).alias("diagonal"))
        .distinct()
    )
    compared = (
        candidates.join(clusters.drop("hits").withColumnRenamed("words", "doc_words"), "cid")
        .join(items.withColumnRenamed("words", "item_words"), "uid")
        .select("doc_id", "ka", "kb", "start", "item_id", "diagonal", "doc_words", "item_words")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                item_at, at, words, same = overlap(
                    np.array(row["doc_words"], np.int64), np.array(row["item_words"], np.int64), row["diagonal"]
                )
                if words:
                    rows.append({
                        "doc_id": row["doc_id"], "ka": row["ka"], "kb": row["kb"], "item_id": row["item_id"],
                        "doc_start": row["start"] + at, "overlap_words": words, "matched_words": same,
                    })
            yield pa.RecordBatch.from_pylist(rows, OVERLAP_ARROW)

    best = F.max(F.struct("matched_words", "overlap_words", (-F.col("doc_start")).alias("back"))).alias("best")
    return (
        compared.mapInArrow(verify, OVERLAP)
        .groupBy("doc_id", "ka", "kb", "item_id").agg(best)
        .select(
            "doc_id", "item_id", (-F.col("best.back")).alias("doc_start"),
            F.col("best.overlap_words").alias("overlap_words"), F.col("best.matched_words").alias("matched_words"), "ka", "kb",
        )
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    with scratch_scope(docs.sparkSession):
        found = contaminated(docs, benchmark, doc_id, text, item_id, item_text).select(
            F.col("doc_id").alias("d__found"), F.col("ka").alias("ka__found"), F.col("kb").alias("kb__found")
        ).distinct()
        # Written, so that its size is known before the rows of docs are shuffled for it.
        found = stage(found, "found", keep=True)
    keyed = docs.withColumn("key__seed", with_key(doc_id, text))
    return keyed.join(
        found,
        F.col(doc_id).cast("long").eqNullSafe(F.col("d__found"))
        & (F.col("key__seed.a") == F.col("ka__found")) & (F.col("key__seed.b") == F.col("kb__found")),
        "left_anti",
    ).drop("key__seed")


CLUSTER = (
    "doc_id long, ka long, kb long, start int, words array<long>, hits array<struct<at:int,mask:int,hash:long>>"
)
CLUSTER_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("start", pa.int32()), ("words", pa.list_(pa.int64())),
    ("hits", pa.list_(pa.struct([("at", pa.int32()), ("mask", pa.int32()), ("hash", pa.int64())]))),
])
OVERLAP = "doc_id long, ka long, kb long, item_id long, doc_start int, overlap_words int, matched_words int"
OVERLAP_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("item_id", pa.int64()),
    ("doc_start", pa.int32()), ("overlap_words", pa.int32()), ("matched_words", pa.int32()),
])

ship(__name__)
