"""The mix against a plain queue, and odd rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from acctlake.llm import mixing as M

SCHEMA = "doc_id long, text string, source string"


def words(text):
    return len(re.findall("[^\\x20\\x09-\\x0D]+", text or ""))


def plain(rows, weights=(5, 2, 1), share=1.5):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        rate = (share * sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if rate * weight[s] >= 2 * sizes[s]}
        if not full:
            target |= {s: rate * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    queue, entries = defaultdict(int), []
    key = lambda r: ("f" * 32 if r[0] is None else hashlib.md5(str(r[0]).encode()).hexdigest(), r[0] is not None, r[0] or 0, words(r[1]))
    for place, row in enumerate(sorted(rows, key=key)):
        source, size = row[2], words(row[1])
        queue[source] += size
        for repeat in range(2):
            if size:
                finish = (queue[source] + repeat * sizes[source]) / target[source] if target[source] else 0.0
                entries.append((finish, source is None, source or "", place, repeat, row, size))
    taken, used = defaultdict(int), 0
    for *_, row, size in sorted(entries, key=lambda e: e[:5]):
        if used + size > int(share * sum(sizes.values())):
            break
        used += size
        taken[row] += size
    return sizes, target, taken


@pytest.mark.parametrize("cut", [4096, 4])
def test_against_a_plain_queue(spark, monkeypatch, cut):
    monkeypatch.setattr(M, "ROWS_PER_CUT", cut)
    rng = random.Random(cut)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 40])), rng.choice(["a", "a", "a", "b", "ü", "c", None])) for i in range(300)]
    rows += [(900, None, "b"), (901, "", "b"), (902, " \t\n\x0b", "empty"), (903, "\x0bone\x1ctwo x three ", "a")]
    got = M.mix(spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", size int, key string"), carried=("key",)).collect()
    sizes, target, taken = plain(rows)
    assert len(got) == len(rows)
    for row in got:
        text, source = next((t, s) for i, t, s in rows if i == row.doc_id)
        assert (row.size, row.source_size, row.carried.key) == (words(text), sizes[source], "x")
        assert math.isclose(row.target, target[source], abs_tol=1e-9)
        assert row.taken == taken[(row.doc_id, text, source)]
    for source in sizes:
        mixed = sum(r.taken for r in got if r.source == source)
        assert abs(mixed - target[source]) <= 41


def test_ties_repeats_and_empty_tables(spark):
    rows = [(1, "a b c", "s")] * 6 + [(None, "a b", "s")] * 2 + [(2, "x", None)]
    got = M.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 9 and all(r.taken in (0, r.size, 2 * r.size) for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * 23) <= 3.5
    assert M.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.taken for r in M.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)).collect()] == [0, 0]


def test_plan_has_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = M.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
