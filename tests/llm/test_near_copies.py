"""Near copies: groups against all pairs by hand, crowded keys too, and the pipeline's stage."""

import random

import pytest

import corpus_pipeline as C
from acctlake.llm import near_copies as N
from acctlake.llm.simhash import fingerprint


def jaccard(a, b):
    sets = []
    for t in (a, b):
        words = (t or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def plain(rows):
    root = {i: i for i, _ in rows}
    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if jaccard(a, b) >= 0.8:
                x, y = root[i], root[j]
                root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    return sorted(sorted(i for i in root if root[i] == r) for r in set(root.values()))


def near(rng, words, changed):
    words = list(words)
    for _ in range(changed):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def documents(seed):
    rng = random.Random(seed)
    texts = [None, "", " ", "one two", "One  two", "one two three four five six"]
    passage = [f"p{i}" for i in range(60)]
    for n in (8, 40, 150):
        for _ in range(4):
            base = [f"w{rng.randrange(5000)}" for _ in range(n)]
            texts += [near(rng, base, c) for c in (0, 1, 2, 3, 5, 8)]
    crowd = [f"c{i}" for i in range(120)]
    texts += [near(rng, crowd, rng.choice((0, 1, 2, 3, 4, 5))) for _ in range(50)]
    # Documents that share a passage and little or nothing else.
    texts += [" ".join([*passage, *(f"w{rng.randrange(5000)}" for _ in range(rng.choice((0, 3, 8, 15, 40, 80))))]) for _ in range(40)]
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "limit"), [(1, 32), (2, 2), (3, 1000)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(N.links, "__defaults__", (N.WIDTH, limit))
    rows = documents(seed)
    got = {}
    for r in N.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.component, []).append(r.doc_id)
    assert sorted(map(sorted, got.values())) == plain(rows)


def test_stage_removes_copies_of_several_changed_words(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = [" ".join(base), near(rng, base, 5), near(rng, base, 30), near(rng, [f"v{i}" for i in range(300)], 0)]
    assert jaccard(texts[0], texts[1]) >= 0.8 > jaccard(texts[0], texts[2])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in C.dedup_near(spark, docs, "").collect()} == {0, 2, 3}


def test_stage_also_removes_what_simhash_links(spark):
    rng = random.Random(9)
    own = [[f"w{rng.randrange(10**6)}" for _ in range(20)] for _ in range(3)]
    cycle = "one two three four five six seven ".split() * 60
    texts = [" ".join([*cycle, *words]) for words in own]
    # Like the last of these by Jaccard, and so linked with the others through it.
    texts += [" ".join([*cycle, *own[2][:-1], "altered"]), "quite another text", None, ""]
    bits = [fingerprint(t) % (1 << 64) for t in texts]
    assert max((bits[0] ^ b).bit_count() for b in bits[:3]) <= 2 and jaccard(texts[0], texts[1]) < 0.5
    assert jaccard(texts[2], texts[3]) >= 0.8
    docs = spark.createDataFrame([(n if n != 1 else None, t) for n, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in C.dedup_near(spark, docs, "").collect()) == [0, 4, 5]
