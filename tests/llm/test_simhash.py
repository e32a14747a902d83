"""SimHash groups against plain fingerprints, all pairs and a union-find."""

import random
import re

import pytest
import xxhash

from acctlake.llm.components import components
from acctlake.llm.simhash import fingerprint, links, near_duplicates

SCHEMA = "doc_id long, text string"


def plain(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprint():
    rng = random.Random(5)
    texts = ["", None, " \t\n", "One", "One two", "a b c", "É É ÄÖ x Y Z", " lead and tail ", "x" * 5000, "q w " * 40000]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for text in texts:
        assert fingerprint(text) % (1 << 64) == plain(text)


@pytest.mark.parametrize("distance,limit", [(2, 64), (2, 2), (3, 64), (1, 64)])
def test_links(spark, distance, limit):
    rng = random.Random(distance)
    values = set()
    for _ in range(12):
        value = rng.getrandbits(64)
        values.add(value)
        for _ in range(12):
            for _ in range(rng.randint(1, 3)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    expected = groups(sorted(signed.values()), lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= distance)
    frame = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    got = {r.node: r.root for r in components(links(frame, distance, 16, limit)).collect()}
    assert {n: got.get(n, n) for n in expected} == expected


def test_near_duplicates(spark):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(400)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.upper().replace("W", "w")) for i, t in enumerate(base)]
    rows += [(200 + i, " ".join(t.split()[:-1] + ["changed"])) for i, t in enumerate(base)]
    rows += [(300, None), (301, ""), (302, " "), (None, base[0]), (7, "short text"), (7, "short text"), (None, "alone here")]
    fps = {}
    for i, t in rows:
        fps.setdefault(plain(t), []).append(i)
    nodes = sorted(fps)
    root = groups(nodes, lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for node in nodes:
        own = [i for i in fps[node] if i is not None]
        least.setdefault(root[node], []).extend(own)
    expected = sorted(
        ((str(i), f"{plain(t):016x}", str(min(least[root[plain(t)]], default=None))) for i, t in rows)
    )
    got = near_duplicates(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", fp int, root int")).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
