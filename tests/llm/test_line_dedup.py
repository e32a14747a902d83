"""Line deduplication against a search for all earlier occurrences."""

import random

import pytest

from acctlake.llm.line_dedup import dedup_lines, shortest_runs

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, min_words):
    """Per (doc_id, text) the positions of lines in runs that occur earlier."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    cut = []
    for key in docs:
        lines = [(p, line.strip(" \t\n\x0b\x0c\r")) for p, line in enumerate(key[1].split("\n"))]
        cut.append((key, [x for x in lines if x[1]]))
    gone = {key: set() for key in docs}
    for n, (key, lines) in enumerate(cut):
        for i in range(len(lines)):
            for m in range(1, len(lines) - i + 1):
                run = [x[1] for x in lines[i : i + m]]
                if sum(len(x.split()) for x in run) < min_words:
                    continue
                earlier = any(
                    [x[1] for x in other[j : j + m]] == run
                    for o, (_, other) in enumerate(cut[: n + 1])
                    for j in range(len(other) - m + 1)
                    if o < n or j < i
                )
                if earlier:
                    gone[key] |= {x[0] for x in lines[i : i + m]}
    return gone


@pytest.mark.parametrize("seed,min_words", [(1, 1), (2, 5), (3, 7), (4, 12)])
def test_against_brute_force(spark, seed, min_words):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(12)]
    rows = []
    for i in range(25):
        text = "\n".join(rng.choice([*lines, "", f"only {i} {rng.random()}"]) for _ in range(rng.randint(0, 14)))
        rows.append((i, text))
    rows += [(30, rows[3][1]), (31, rows[4][1] + "\ntail"), (None, rows[5][1]), (40, None), (30, rows[3][1]), (41, "")]
    expected = brute(rows, min_words)
    got = dedup_lines(spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA), min_words).collect()
    assert len(got) == len(rows)
    ids = {i: t for i, t in rows if i != 30}
    for row in got:
        text = rows[3][1] if row.doc_id == 30 else ids[row.doc_id]
        if text is None:
            assert row.text is None and row.lines_deleted == []
            continue
        gone = expected[(row.doc_id, text)]
        assert set(row.lines_deleted) == gone
        assert row.text == "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone)


def test_columns_and_empty_table(spark):
    schema = "doc_id long, text string, pos int, rank int, seq int, d string, key int, lines_deleted int"
    empty = spark.createDataFrame([], schema)
    assert dedup_lines(empty).collect() == []
    one = spark.createDataFrame([(1, "a b c d e f\na b c d e f", 1, 2, 3, "x", 4, 5)], schema)
    row = dedup_lines(one).first()
    assert (row.text, row.pos, row.rank, row.seq, row.d, row.key) == ("a b c d e f", 1, 2, 3, "x", 4)
    assert row.lines_deleted == [1]


def test_long_copy(spark):
    text = "\n".join(f"line {i} of a long text" for i in range(3000))
    got = dedup_lines(spark.createDataFrame([(1, text, "en"), (2, "own words of the other one\n" + text, "en")], SCHEMA))
    assert {r.doc_id: r.text for r in got.collect()} == {1: text, 2: "own words of the other one"}


def test_shortest_runs():
    assert shortest_runs([2, 2, 9, 1], [0, 1, 2, 5], 4) == {(0, 2), (1, 2), (2, 1)}


def test_very_many_deleted_lines_in_one_document(spark):
    long = "\n".join(f"line {i} of a very long list" for i in range(100_000))
    rows = [(1, long), (2, "before it\n" + long + "\n\nafter it"), (3, None)]
    found = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].text == long and found[2].text == "before it\n\nafter it" and found[3].text is None
    assert len(found[2].lines_deleted) == 100_000
