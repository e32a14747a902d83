"""The trie against plain dictionaries, whatever the size of a container."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from acctlake.llm import conversation_trie as T
from acctlake.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        out[c] = seqs.get(c - base, [])[:h] + own[h:]
    return out


def plain(seqs):
    members, ends = defaultdict(set), defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
        ends[tuple(seq)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, saved, leaves = [], {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[k] for k in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in below)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def found(nodes):
    return sorted((tuple(r) for r in nodes.select(*T.COLUMNS).collect()), key=str)


def talk(seed, n, width):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 6])):
            rows.append((c * 7 % n, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "ü" * 3][:width])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit,seed,width", [(1, 1, 2), (2, 2, 5), (5, 3, 3), (128, 4, 4)])
def test_against_dictionaries(spark, limit, seed, width):
    rows = talk(seed, 120, width)
    nodes = T.prefix_trie(T.turn_sequences(spark.createDataFrame(rows, SCHEMA)), limit)
    assert found(nodes) == plain(ordered(rows))


@pytest.mark.parametrize("limit", [3, 128])
def test_rebuilt_conversations(spark, monkeypatch, limit):
    monkeypatch.setattr(T, "PART", 3)
    rows = talk(9, 320, 4) + [(-5, 0, "user", "a"), (-150, 2, "user", "bb"), (2**40, 0, "user", "a")]
    # Many copies of one conversation.
    rows += [(10_000 + i, t, "user", "same") for i in range(150) for t in range(4)]
    table = spark.createDataFrame(rows, SCHEMA)
    nodes = T.prefix_trie(Q.with_shared_beginnings(T.turn_sequences(table)), limit)
    assert found(nodes) == plain(rebuilt(ordered(rows)))


def test_long_shared_beginning_bursts_in_few_rounds(spark, monkeypatch):
    rows = [(c, t, "user", "same" if t < 60 else f"{c % 20}") for c in range(40) for t in range(62)]
    rounds = []
    stage = T.stage
    monkeypatch.setattr(T, "stage", lambda df, label: rounds.append(label) or stage(df, label))
    nodes = T.prefix_trie(T.turn_sequences(spark.createDataFrame(rows, SCHEMA)), 4)
    assert found(nodes) == plain(ordered(rows))
    assert rounds.count("containers") == 1


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (1, None, "user", "first"), (1, 1, "b", "tie"), (1, 1, "a", "tie"), (1, 1, "a", "tie"),
        (2, None, None, None), (3, 5, "ab", "c"), (4, 5, "a", "bc"), (5, 0, "user", "x" * 300_000),
    ]
    table = spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA + ", head int, first string")
    assert found(T.prefix_trie(T.turn_sequences(table))) == plain(ordered(rows))


def test_empty_table(spark):
    assert found(T.prefix_trie(T.turn_sequences(spark.createDataFrame([], SCHEMA)))) == []
