"""Repeated runs of lines, found with suffix ranks made by distributed prefix doubling.

The documents, in order of ``doc_id``, form one long sequence of line ids; a run never crosses a document.
Rank level 0 orders the lines that occur more than once. Level t + 1 ranks the pairs (rank of 2^t lines at
i, rank of 2^t lines at i + 2^t) that occur more than once, in sorted order: it is the order of the
suffixes by their first 2^(t+1) lines. Suffixes whose prefix is unique drop out, so levels shrink. Suffixes that
agree in m lines stand together in the suffix array, an interval of longest common prefix m; they
are those with the same two ranks of overlapping power-of-two prefixes that cover m lines.

A run counts if it has ``min_words`` words. It is enough to look, at each line, at the shortest run that starts or ends
there and has so many words: a maximal run that counts is exactly covered by these. So no level
beyond log2(min_words) is needed, however long the copies are. In each interval the first suffix is kept
and the lines of all later ones are deleted; every deleted line still stands at an earlier place.

Scale. Sums by line and by pair are combined before the shuffle; only lines that repeat go on; a line
that stands in a third of all documents is a skewed join key, which adaptive execution splits. Lines
of one document come together, never those of a group. Each step is a written table.

Defined results. Lines are compared without white space at their ends. Blank lines take no part and stay.
Rows with the same doc_id and text are one document and get the same result; rows with the same doc_id and different
texts are ordered by a hash of the text. A NULL doc_id comes first. NULL text stays NULL. Copies may overlap the
first one (the line ``x`` five times leaves fewer). Any other columns are carried along unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlake.llm.common import SPACE, scratch_scope, ship, stage, with_key, word_count

MIN_WORDS = 5

#: Columns that tell documents apart, in text order.
DOC = ("d", "ka", "kb")


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line that is not blank: document, ``seq`` among these, ``pos`` among all lines, line id, words."""
    stripped = F.transform(
        F.split(F.col("t"), "\n"),
        lambda line, i: F.struct(
            i.cast("int").alias("pos"), F.regexp_replace(line, rf"\A{SPACE}|{SPACE}\z", "").alias("line")
        ),
    )
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"), with_key(doc_id, text).alias("k")
    ).where("t is not null")
    exploded = keyed.select(
        "d", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"),
        F.posexplode(F.filter(stripped, lambda s: s["line"] != "")).alias("seq", "s"),
    )
    line = F.col("s.line")
    return exploded.select(
        *DOC, "seq", F.col("s.pos").alias("pos"),
        F.xxhash64(line).alias("ha"), F.xxhash64(F.lit(1), line).alias("hb"),
        word_count(line).cast("int").alias("words"),
    )


def _ranked(pairs: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """``a, b, rank`` of the pairs that occur more than once; ranks ascend with the pairs."""
    repeated = pairs.groupBy(a, b).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return stage(
        repeated.repartitionByRange(a, b).sortWithinPartitions(a, b)
        .withColumn("rank", F.monotonically_increasing_id()),
        label,
    )


def repeated_lines(lines: DataFrame) -> DataFrame:
    """Level 0: document, ``seq``, ``pos``, ``words``, ``rank`` of every line that occurs more than once."""
    ranks = _ranked(lines, "ha", "hb", "ranks")
    return stage(lines.join(ranks, ["ha", "hb"]).select(*DOC, "seq", "pos", "words", "rank").distinct(), "level")


def suffix_ranks(level0: DataFrame, levels: int) -> list[DataFrame]:
    """Per level t: document, ``seq``, ``rank`` of every suffix whose first 2^t lines occur elsewhere too."""
    found = [level0.select(*DOC, "seq", "rank")]
    for t in range(levels):
        ahead = Window.partitionBy(*DOC).orderBy("seq").rangeBetween(1 << t, 1 << t)
        pairs = found[-1].withColumn("second", F.min("rank").over(ahead)).where("second is not null")
        pairs = stage(pairs.withColumnRenamed("rank", "first"), "pairs")
        ranks = _ranked(pairs, "first", "second", "ranks")
        found.append(stage(pairs.join(ranks, ["first", "second"]).select(*DOC, "seq", "rank"), "level"))
    return found


def shortest_runs(words: list[int], seqs: list[int], min_words: int) -> set[tuple[int, int]]:
    """(start, length) of the shortest runs of consecutive ``seqs`` with ``min_words``, from each start and to each end."""
    runs: set[tuple[int, int]] = set()
    n, at = len(seqs), 0
    while at < n:
        stop = at + 1
        while stop < n and seqs[stop] == seqs[stop - 1] + 1:
            stop += 1
        end, total = at, 0
        for start in range(at, stop):
            while end < stop and total < min_words:
                total += words[end]
                end += 1
            if total < min_words:
                break
            runs.add((seqs[start], end - start))
            total -= words[start]
        start, total = at, 0
        for end in range(at, stop):
            total += words[end]
            while total - words[start] >= min_words and start < end:
                total -= words[start]
                start += 1
            if total >= min_words:
                runs.add((seqs[start], end + 1 - start))
        at = stop
    return runs


def candidate_runs(level0: DataFrame, min_words: int) -> DataFrame:
    """Document, ``seq`` (start), ``length``: the runs of repeated lines that are compared."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for d, ka, kb, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start, length in sorted(shortest_runs([x["words"] for x in lines], [x["seq"] for x in lines], min_words)):
                    for column, value in zip(out, (d, ka, kb, start, length), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, [pa.int64()] * 3 + [pa.int32()] * 2, strict=True)],
                ["d", "ka", "kb", "seq", "length"],
            )

    # The repeated lines of one document come together; a document is one row already.
    gathered = level0.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("seq", "words"))).alias("lines"))
    return gathered.mapInArrow(each, "d long, ka long, kb long, seq int, length int")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Document, ``pos`` of every line that belongs to a later copy of a run."""
    lines = stage(line_table(docs, doc_id, text), "lines")
    level0 = repeated_lines(lines)
    runs = stage(candidate_runs(level0, min_words), "runs")
    longest = runs.agg(F.max("length")).first()[0] or 1
    found = suffix_ranks(level0, longest.bit_length() - 1)
    power = F.floor(F.log2("length") + F.lit(1e-9)).cast("int")
    runs = runs.withColumn("p", power).withColumn(
        "last", (F.col("seq") + F.col("length") - F.expr("shiftleft(1, p)")).cast("int")
    )
    intervals = None
    for p, level in enumerate(found):
        some = _lookup(runs.where(F.col("p") == p), "seq", level.withColumnRenamed("rank", "first_rank"))
        some = _lookup(some, "last", level.withColumnRenamed("rank", "last_rank"))
        intervals = some if intervals is None else intervals.unionByName(some)
    key = ["length", "first_rank", "last_rank"]
    intervals = stage(intervals.select(*DOC, "seq", *key), "intervals")
    place = F.struct(*DOC, "seq")
    first = intervals.groupBy(*key).agg(F.min(place).alias("kept"), F.max(place).alias("other")).where("kept < other")
    # Written, so that the join shuffles both sides for itself and can split an interval that has very many suffixes.
    first = stage(first.drop("other"), "first")
    later = intervals.join(first, key).where(place > F.col("kept"))
    deleted = later.select(*DOC, F.explode(F.expr("sequence(seq, seq + length - 1)")).alias("seq")).distinct()
    return _lookup(deleted, "seq", level0.select(*DOC, "seq", "pos")).select(*DOC, "pos")


def _lookup(left: DataFrame, seq: str, right: DataFrame) -> DataFrame:
    """Inner join on the document and its line ``seq``; a NULL doc_id equals itself."""
    other = right.select([F.col(c).alias(f"{c}_") if c in (*DOC, "seq") else F.col(c) for c in right.columns])
    same = F.col("d").eqNullSafe(F.col("d_")) & (F.col(seq) == F.col("seq_"))
    return left.join(other, same & (F.col("ka") == F.col("ka_")) & (F.col("kb") == F.col("kb_"))).drop(
        "d_", "ka_", "kb_", "seq_"
    )


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs``, later copies deleted from the text, plus ``lines_deleted`` (the positions).

    ``lines_deleted`` replaces a column of that name.
    """
    with scratch_scope(docs.sparkSession):
        copies = later_copies(docs, min_words, doc_id, text)
        # The lines of one document.
        per_doc = copies.groupBy(*DOC).agg(F.sort_array(F.collect_list("pos")).alias("lines_deleted__"))
        per_doc = stage(per_doc.select(*[F.col(c).alias(f"{c}__line") for c in DOC], "lines_deleted__"), "deleted", keep=True)
    carried = docs.drop("lines_deleted").withColumn("key__line", with_key(doc_id, text))
    joined = carried.join(
        per_doc,
        F.col(doc_id).cast("long").eqNullSafe(F.col("d__line"))
        & (F.col("key__line.a") == F.col("ka__line")) & (F.col("key__line.b") == F.col("kb__line")),
        "left",
    ).drop("key__line", "d__line", "ka__line", "kb__line")
    gone = F.col("lines_deleted__")
    # One look-up set per document; the lines are bound once, as a lambda's variable.
    kept = F.transform(
        F.array(F.split(F.col(text), "\n")),
        lambda lines: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: lines[i]), "\n"
        ),
    )[0]
    return (
        joined.withColumn(text, F.when(gone.isNull(), F.col(text)).otherwise(kept))
        .withColumn("lines_deleted", F.coalesce(gone, F.array().cast("array<int>")))
        .drop("lines_deleted__")
    )


ship(__name__)
