"""Spaced seeds against a comparison of all windows at all places."""

import itertools
import math
import random
import re

import pytest

from acctlake.llm.decontaminate import MASKS, SHORTEST, SIMILARITY, WINDOW, contaminated, masks_for, without_contaminated

DOCS = "doc_id long, text string"


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def holds(doc, item):
    doc, item = words(doc), words(item)
    width = min(WINDOW, len(item))
    if width < SHORTEST:
        return False
    return any(
        sum(a == b for a, b in zip(item[i : i + width], doc[j : j + width])) >= math.ceil(SIMILARITY * width)
        for i in range(len(item) - width + 1)
        for j in range(len(doc) - width + 1)
    )


@pytest.mark.parametrize("n", range(SHORTEST, WINDOW + 5))
def test_masks_hit_every_tolerated_window(n):
    width = min(n, WINDOW)
    wrong = width - math.ceil(SIMILARITY * width)
    for missing in itertools.combinations(range(width), wrong):
        assert any(
            all(at + o not in missing for o in MASKS[m])
            for m in masks_for(n)
            for at in range(width - MASKS[m][-1])
        ), (n, missing)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split())
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 20, 45, 13])]
    items += [(None, " ".join(word() for _ in range(16))), (14, None), (15, ""), (3, items[4][1])]
    docs = []
    for i in range(120):
        text = [word() for _ in range(rng.randint(0, 50))]
        if i % 2:
            part = words(rng.choice(items)[1])
            for _ in range(rng.randint(0, 4)):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(["new", "ab"])
            at = rng.randint(0, len(text))
            text[at:at] = part
        docs.append((i, " ".join(text)))
    docs += [(200, None), (201, ""), (None, items[12][1]), (202, items[12][1]), (202, items[12][1]), (202, "none here")]
    expected = {(d, i) for d, t in docs for i, s in items if holds(t, s)}
    docs_frame = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", hash int, words string")
    bench = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, uid string")
    got = contaminated(docs_frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected
    assert len(got) == len({(r.doc_id, r.item_id, r.ka) for r in got})
    kept = without_contaminated(docs_frame, bench)
    assert kept.columns == docs_frame.columns
    clean = [(d, t) for d, t in docs if not any(holds(t, s) for _, s in items)]
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame(clean, DOCS).collect())
    )


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], DOCS)
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert contaminated(docs.limit(0), bench).collect() == []
    assert contaminated(docs, bench.limit(0)).collect() == []
    assert contaminated(docs, bench).count() == 1
