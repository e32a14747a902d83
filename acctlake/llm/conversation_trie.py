"""Prefix trie of conversations, built as a burst trie.

A turn's id is the md5 of role and text; a conversation is the row of its turn ids, packed into one binary, so comparing
binaries compares conversations turn by turn. Conversations with equal turns are one sequence with its members counted. All sequences
begin in one container under the root. A container with more than ``limit`` sequences bursts: what its least and its greatest sequence
share, all share, so this path becomes the head at once, however long it is, and the sequences move to one container per next turn.
Containers that are small enough are sorted and swept once, with a stack of open nodes. Numbers of a head are then added up from
the containers and heads below it, from the last round of bursts to the first.

Scale. Texts are read once and not shuffled; a container is at most ``limit`` sequences, so no task gets a hot first turn. A burst takes
one combined aggregate and a join with the few containers that are too large, which is written before. Rounds go with the depth of branching
among large containers, not with the length of shared beginnings. The members that end in one node are put into text in
parts by many tasks; one task then only hashes the parts in order, as SHA-256 demands. A conversation is one row of 20 bytes a turn.

Defined results. Turns are ordered by turn, NULL first, ties by role and the md5 of role and text. NULL roles and texts are empty; rows
with a NULL conv_id name no conversation and take no part. Repeated rows are turns of their own. A conversation without turns (from a
caller that cuts them) is a member of the root only. Empty tables give no rows, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acctlake.llm.common import ship, stage

#: Bytes of a turn id.
TURN = 16
#: Sequences that a container holds before it bursts.
LIMIT = 128
#: Ids that are put into text at a time.
PART = 4096
NOBODY = hashlib.sha256(b"").hexdigest()

#: What is known of a node; ``parent_conv_id`` is NULL for the root and for tops of containers until heads are known.
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
COLUMNS = [field.split()[0] for field in NODE.split(", ")]


def turn_sequences(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, seq, chars``: turn ids of each conversation in order, packed, and the code points of each turn's text."""
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    turn_id = F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_))
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), role_.alias("role"), turn_id.alias("id"), F.length(text_).alias("chars")).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return gathered.select("conv_id", F.unhex(F.array_join("t.id", "")).alias("seq"), F.col("t.chars").alias("chars"))


def first_turns(seq: Column, chars: Column, count: Column) -> tuple[Column, Column]:
    """The first ``count`` turns, all if there are fewer."""
    return F.substring(seq, F.lit(1), count * TURN), F.slice(chars, F.lit(1), count)


def later_turns(seq: Column, chars: Column, count: Column) -> tuple[Column, Column]:
    """The turns after the first ``count``, none if there are not so many."""
    left = F.greatest(F.size(chars) - count, F.lit(0))
    return F.substring(seq, count * TURN + 1, left * TURN), F.slice(chars, count + 1, left)


def _members(sequences: DataFrame) -> DataFrame:
    """``key, n, first, sha`` per distinct sequence: number of members, the smallest, the digest of all in ascending order."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([ids[0]]), pa.array([len(ids)]), pa.array([",".join(map(str, ids))])],
                ["key", "first", "n", "ids"],
            )

        for batch in batches:
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (k != key or len(ids) == PART):
                    yield part()
                    ids = []
                key = k
                ids.append(i)
        if ids:
            yield part()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, sha, out = None, 0, 0, hashlib.sha256(), []

        def full(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.int64(), pa.string()], strict=True)],
                ["key", "n", "first", "sha"],
            )

        for batch in batches:
            for k, i, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, n, first, sha.hexdigest()))
                    key, first, n, sha = k, i, 0, hashlib.sha256()
                elif n:
                    sha.update(b",")
                sha.update(ids.encode())
                n += count
                if len(out) == 4096:
                    yield full(out)
                    out = []
        if key is not None:
            out.append((key, n, first, sha.hexdigest()))
            yield full(out)

    parts = (
        sequences.select(F.md5("seq").alias("key"), "conv_id").repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id").mapInArrow(texts, "key string, first long, n long, ids string")
    )
    return parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        digests, "key string, n long, first long, sha string"
    )


def shared(a: bytes, b: bytes) -> int:
    """Number of turns that two packed sequences begin with in common."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // TURN
    x, y = (np.frombuffer(s, np.uint8, size) for s in (a, b))
    return int(np.argmax(x != y)) // TURN


def _burst(sequences: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Containers that fit, heads of those that did not (per round), and the sequences that end in a head."""

    def path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = [shared(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(common, pa.int32())], ["head", "one", "common"])

    fitting, heads, ended = [], [], []
    # Written with its head: a constant would make the join with the containers a nested loop.
    open_ = stage(
        sequences.withColumns({
            "head": F.lit("root"), "depth": F.lit(0), "above": F.lit(None).cast("string"), "round": F.lit(0),
        }),
        "distinct",
    )
    while True:
        sizes = open_.groupBy("head").agg(
            F.count("*").alias("n"), F.min("seq").alias("least"), F.max("seq").alias("most"), F.min("first").alias("one")
        )
        large = stage(
            sizes.where(F.col("n") > limit).select("head", "least", "most", "one").mapInArrow(path, "head string, one long, common int"),
            "oversized",
        )
        if large.isEmpty():
            fitting.append(open_)
            return fitting, heads, ended
        met = stage(open_.join(large, "head", "left"), "containers")
        fitting.append(met.where("common is null").drop("one", "common"))
        met = met.where("common is not null")
        levels = F.slice("chars", F.greatest("depth", F.lit(1)), F.col("common") - F.greatest("depth", F.lit(1)) + 1)
        heads.append(
            met.where("first = one").select(
                "head", "depth", "above",
                F.when(F.col("depth") == 0, F.concat(F.array(F.lit(0)), levels)).otherwise(levels).alias("levels"),
            )
        )
        at_end = F.size("chars") == F.col("common")
        ended.append(met.where(at_end).select("head", "n", "first", "sha"))
        below = F.md5(F.substring("seq", F.lit(1), (F.col("common") + 1) * TURN))
        open_ = met.where(~at_end).select(
            "seq", "chars", "n", "first", "sha", below.alias("head"), (F.col("common") + 1).alias("depth"),
            F.col("head").alias("above"), (F.col("round") + 1).alias("round"),
        )


class _Open:
    """A node whose subtree is still being swept."""

    __slots__ = ("chars", "children", "first", "leaves", "n", "saved", "sha", "waiting")

    def __init__(self, chars: int) -> None:
        self.chars, self.n, self.children, self.leaves, self.saved = chars, 0, 0, 0, 0
        self.first, self.sha, self.waiting = None, NOBODY, []

    def add(self, n: int, first: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(self.first, first)


def _sweep(fitting: DataFrame) -> DataFrame:
    """All nodes of the containers; those at their top have ``top`` true, the head ``above`` and the ``round``."""
    schema = f"{NODE}, above string, round int, top boolean"
    arrow = [pa.int64()] * 7 + [pa.string(), pa.string(), pa.int32(), pa.bool_()]
    names = [field.split()[0] for field in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        out: list[tuple] = []
        head, base, above, round_, before = None, 0, None, 0, b""

        def close(down_to: int) -> None:
            """Close the open nodes deeper than ``down_to``; children learn their parent when it closes."""
            while stack and base + len(stack) - 1 > down_to:
                node = stack.pop()
                out.extend((*row[:2], node.first, *row[2:], None, None, False) for row in node.waiting)
                saved = node.saved + (node.n - 1) * node.chars
                row = (node.first, base + len(stack), node.n, node.children, node.leaves or 1, saved, node.sha)
                if not stack:
                    out.append((*row[:2], None, *row[2:], above, round_, True))
                    return
                up = stack[-1]
                up.add(node.n, node.first)
                up.children, up.leaves, up.saved = up.children + 1, up.leaves + (node.leaves or 1), up.saved + saved
                up.waiting.append(row)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], names)

        for batch in batches:
            for key, depth, up, number, seq, chars, n, first, sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != head:
                    close(-1)
                    head, base, above, round_ = key, depth, up, number
                    stack.append(_Open(chars[depth - 1] if depth else 0))
                else:
                    close(shared(before, seq))
                stack.extend(_Open(chars[d]) for d in range(base + len(stack) - 1, len(chars)))
                stack[-1].sha = sha
                stack[-1].add(n, first)
                before = seq
                if len(out) >= 4096:
                    yield batch_of(out)
                    out.clear()
        close(-1)
        if out:
            yield batch_of(out)

    swept = fitting.select("head", "depth", "above", "round", "seq", "chars", "n", "first", "sha")
    return swept.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(each, schema)


def prefix_trie(sequences: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row per node, columns of ``NODE``; ``sequences`` has ``conv_id, seq, chars`` as :func:`turn_sequences` gives them.

    A node is a distinct beginning; ``conv_id`` is its smallest member, ``saved_tokens`` what a cache of shared beginnings saves in its subtree.
    """
    sequences = stage(sequences.select("conv_id", "seq", "chars"), "sequences")
    members = stage(_members(sequences), "members")
    distinct = sequences.join(members.drop("key"), F.col("conv_id") == F.col("first")).select("seq", "chars", "n", "first", "sha")
    fitting, heads, ended = _burst(distinct, limit)
    swept = stage(_sweep(reduce(DataFrame.unionByName, fitting)), "swept")
    inner = swept.where(~F.col("top")).select(*COLUMNS)
    tops = swept.where("top").drop("top")

    # From the deepest heads to the root: what lies below a head is known when its round comes.
    known, paths = [], []
    below = None
    for number in reversed(range(len(heads))):
        children = tops.where(F.col("round") == number + 1).select(
            F.col("above").alias("head"), "n_convs", F.col("conv_id").alias("first"), F.lit(1).alias("children"), "n_leaves",
            "saved_tokens", F.lit(None).cast("string").alias("sha"),
        )
        ends = ended[number].select(
            "head", F.col("n").alias("n_convs"), "first", F.lit(0).alias("children"), F.lit(0).alias("n_leaves"),
            F.lit(0).alias("saved_tokens"), "sha",
        )
        rows = children.unionByName(ends)
        if below is not None:
            rows = rows.unionByName(below)
        totals = rows.groupBy("head").agg(
            F.sum("n_convs").alias("n_convs"), F.min("first").alias("first"), F.sum("children").alias("children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("sha").alias("sha"),
        )
        done = stage(heads[number].join(totals, "head"), "heads")
        paid = F.aggregate("levels", F.lit(0).cast("long"), lambda acc, c: acc + c)
        below = done.where("above is not null").select(
            F.col("above").alias("head"), "n_convs", "first", F.lit(1).alias("children"), "n_leaves",
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * paid).alias("saved_tokens"), F.lit(None).cast("string").alias("sha"),
        )
        known.append(done.select("head", F.col("first").alias("upper")))
        # The path of a head: all its nodes have the same members, only the last one branches.
        deeper = Window.partitionBy("head").orderBy(F.desc("at"))
        paths.append(
            done.select("*", F.posexplode("levels").alias("at", "own")).select(
                F.col("first").alias("conv_id"), (F.col("depth") + F.col("at")).cast("long").alias("depth"),
                F.when(F.col("at") > 0, F.col("first")).alias("parent_conv_id"), "n_convs",
                F.when(F.col("at") == F.size("levels") - 1, F.col("children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
                (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.sum("own").over(deeper)).cast("long").alias("saved_tokens"),
                F.when(F.col("at") == F.size("levels") - 1, F.coalesce("sha", F.lit(NOBODY))).otherwise(NOBODY).alias("ends_sha256"),
                F.when(F.col("at") == 0, F.col("above")).alias("above"),
            )
        )
    nodes = reduce(DataFrame.unionByName, [tops.drop("round"), *paths])
    if known:
        # Written first: a head above very many tops is then a key that the join can split.
        upper = stage(reduce(DataFrame.unionByName, known), "upper").withColumnRenamed("head", "above")
        nodes = nodes.join(upper, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "upper"))
    return nodes.select(*COLUMNS).unionByName(inner)


ship(__name__)
