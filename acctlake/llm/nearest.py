"""Nearest vectors by cosine, from several shifted Hilbert orderings of projected vectors.

Each curve projects the normalised vectors on a few random directions of its own, shifts them, and orders them by their Hilbert key. A
query is compared with the rows within a window on either side of its place in each order; the best of all
windows are ranked again by the exact cosine in double precision.

The window is a share of all rows. Vectors with structure need little of it; vectors that are mostly noise have neighbours that are
hardly closer than the rest, and only a wide window reaches a recall of 0.9 for them. ``SHARE`` is set for these; set ``share`` smaller where
``recall`` allows it.

Scale. Equal vectors are one row that stands for its smallest ids, so a vector that a third of all rows have is
compared once. Places come from a range sort with a running count for each part. Ordered rows are cut into
blocks and ordered queries into chunks, both of a fixed number of rows, and only chunk and block pairs whose windows meet are joined; each pair is
one matrix product in a task and passes on a few rows per query. The work is queries x share x rows, split evenly, whatever
the data look like. Nothing is collected but one count per part of the range sort.

Defined results. Vectors that are NULL, of length zero, or hold NULL or non-finite components and rows without id take no part.
Vectors of each dimension are a table of their own: a cosine needs two of the same one. Before it is squared a vector is divided by the power of two
next to its largest component, which changes no cosine, so vectors of any length that doubles can hold have one. Rows with the same id and vector count once. With fewer candidates than asked for all are
returned; a query without any has no rows. Equal scores go to the smaller id. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctlake.llm.common import ship, stage

CURVES = 4
#: Share of all rows in the window of one curve.
SHARE = 0.4
#: Directions of one curve and bits of each.
DIRECTIONS, BITS = 6, 9
BLOCK_ROWS = 2048
CHUNK_QUERIES = 256
#: Rows of a block that are scored exactly for a query, besides the wanted ones.
SPARE = 16
SEED = 20_240_607


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of whole numbers below 2^bits on the Hilbert curve of its dimension.

    Gray-code walk from the highest bit down: in each step the part of the cube that a point is in decides how the
    remaining bits are reflected and which axes change places.
    """
    x = points.astype(np.uint64).T.copy()
    axes = len(x)
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        high, below = one << np.uint64(bit), (one << np.uint64(bit)) - one
        for axis in range(axes):
            upper = (x[axis] & high) != 0
            swapped = np.where(upper, np.uint64(0), (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(upper, below, swapped)
            if axis:
                x[axis] ^= swapped
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(bit)) & one, (one << np.uint64(bit)) - one, np.uint64(0))
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << one) | ((x[axis] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two, so that its largest component is between a half and one; no row is zero."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Hilbert keys of the (scaled) rows on one curve."""
    rng = np.random.default_rng(SEED + curve)
    size = vectors.shape[1]
    directions = rng.standard_normal((size, DIRECTIONS))
    shift = rng.random(DIRECTIONS)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    # A coordinate is near a standard normal number: 8 deviations fill the cube, the shift moves by up to one.
    place = (unit @ directions + shift + 4) / 9
    cells = np.clip((place * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return hilbert(cells, BITS)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, the same number for the same two vectors in any block."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(axis=1)))


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, dim, v`` of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .where(~bad).where(F.exists("v", lambda x: x != 0))
    )
    return stage(kept.distinct().select("vec_id", F.size("v").alias("dim"), "v"), "vectors")


def classes(rows: DataFrame, is_query: Column | str, kept: int) -> DataFrame:
    """``cls, dim, v, ids, asked``: one row per different vector, with its ``kept`` smallest ids and whether a query has it."""
    order = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ids = rows.withColumn("n", order).where(F.col("n") <= kept)
    ids = ids.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(is_query).select("v").distinct().withColumn("asked", F.lit(True))
    return stage(
        ids.join(asked, "v", "left").select(
            F.col("ids")[0].alias("cls"), F.size("v").alias("dim"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked")
        ),
        "classes",
    )


def ordered(found: DataFrame, curves: int) -> DataFrame:
    """``dim, curve, place, cls``: places 0, 1, ... of all classes of a dimension on each curve."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                vectors = scaled(_matrix(rows.column(2)))
                for curve in range(curves):
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(1), pa.array(np.full(len(vectors), curve, np.int32)),
                         pa.array(curve_keys(vectors, curve)), rows.column(0)],
                        ["dim", "curve", "key", "cls"],
                    )

    keyed = found.select("cls", "dim", "v").mapInArrow(each, "dim int, curve int, key long, cls long")
    order = ["dim", "curve", "key", "cls"]
    sorted_ = stage(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("row", 33)
    # One row per dimension, curve and part of the sort.
    firsts = sorted_.groupBy("dim", "curve", part.alias("part")).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = firsts.select(
        "dim", "curve", "part", "first",
        (F.sum("n").over(Window.partitionBy("dim", "curve").orderBy("part")) - F.col("n")).alias("before"),
    )
    # Written, so that its size is known and the join can split a part.
    before = stage(before, "before")
    return (
        sorted_.withColumn("part", part).join(before, ["dim", "curve", "part"])
        .select("dim", "curve", (F.col("before") + F.col("row") - F.col("first")).alias("place"), "cls")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def best_pairs(found: DataFrame, share: float, curves: int, wanted: int) -> DataFrame:
    """``asker, cls, score``: for each asked class the best classes of its windows, with repeats from several curves."""
    # One row per dimension.
    sizes = stage(found.groupBy("dim").agg(F.count("*").alias("total")), "sizes")
    places = ordered(found, curves).join(found.select("cls", "dim", "v", "asked"), ["cls", "dim"])
    places = stage(places.select("dim", "curve", "place", "cls", "v", "asked"), "places")

    row = F.struct("cls", "v")
    blocks = places.groupBy("dim", "curve", F.floor(F.col("place") / BLOCK_ROWS).alias("block")).agg(
        F.collect_list(row).alias("rows")
    )
    # Queries in order; the n-th of a curve is counted within cuts of the places, so no curve is sorted in one task.
    asked = places.where("asked").withColumn("cut", F.floor(F.col("place") / (BLOCK_ROWS * 16)))
    within = F.row_number().over(Window.partitionBy("dim", "curve", "cut").orderBy("place"))
    asked = asked.withColumn("chunk", F.floor((within - 1) / CHUNK_QUERIES))
    chunk = ["dim", "curve", "cut", "chunk"]
    chunks = asked.groupBy(*chunk).agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.collect_list(row).alias("askers")
    )
    half = F.greatest(F.floor(F.col("total") * (share / 2)), F.lit(wanted + SPARE))
    first = F.greatest(F.col("low") - half, F.lit(0))
    last = F.least(F.col("high") + half, F.col("total") - 1)
    pairs = chunks.join(sizes, "dim").select(
        *chunk, F.explode(F.sequence(F.floor(first / BLOCK_ROWS), F.floor(last / BLOCK_ROWS))).alias("block")
    )
    joined = pairs.join(chunks.select(*chunk, "askers"), chunk).join(blocks, ["dim", "curve", "block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                askers, rows = batch.column(0)[n].values, batch.column(1)[n].values
                a, b = scaled(_matrix(askers.field("v"))), scaled(_matrix(rows.field("v")))
                ids = rows.field("cls").to_numpy()
                near = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
                some = min(wanted + SPARE, len(b))
                top = np.argpartition(-near, some - 1, axis=1)[:, :some]
                out: list[list] = [[], [], []]
                for i, asker in enumerate(askers.field("cls").to_pylist()):
                    score = cosine(a[i], b[top[i]])
                    order = np.lexsort((ids[top[i]], -score))[:wanted]
                    out[0] += [asker] * len(order)
                    out[1].append(ids[top[i]][order])
                    out[2].append(score[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(np.concatenate(out[1])), pa.array(np.concatenate(out[2]))],
                    ["asker", "cls", "score"],
                )

    return joined.select("askers", "rows").mapInArrow(compare, "asker long, cls long, score double")


def nearest(
    vectors: DataFrame, is_query: Column | str, k: int = 5, share: float = SHARE, curves: int = CURVES,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row that ``is_query`` (over ``vec_id``) selects."""
    rows = valid(vectors, vec_id, embedding)
    found = classes(rows, is_query, k + 1)
    # An id's own row is left out later: one more is kept.
    scored = best_pairs(found, share, curves, k + 1).groupBy("asker", "cls").agg(F.max("score").alias("score"))
    candidates = (
        scored.join(found.select("cls", "ids"), "cls").select("asker", "score", F.explode("ids").alias("id"))
    )
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "id")
    lists = (
        candidates.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
        .groupBy("asker").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("list"))
    )
    askers = (
        rows.where(is_query).join(found.where("asked").select("v", F.col("cls").alias("asker")), "v")
        .select(F.col("vec_id").alias("query_id"), "asker")
    )
    own = F.col("query_id")
    others = F.slice(F.filter("list", lambda x: x["id"] != own), 1, k)
    return (
        askers.join(lists, "asker")
        .select("query_id", F.posexplode(others).alias("rank", "x"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
    )


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the rows of ``exact`` (``query_id, vec_id``) that ``found`` has, too."""
    pair = ["query_id", "vec_id"]
    total = exact.count()
    return exact.select(*pair).join(found.select(*pair), pair, "left_semi").count() / total if total else 1.0


ship(__name__)
