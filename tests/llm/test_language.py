"""Language inference: held-out accuracy, mixtures, and the algorithm on plain numbers."""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from acctlake.llm import common
from acctlake.llm import language as L
from acctlake.llm.common import table
from acctlake.llm.queries import op1_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op1_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == table(spark, SF, "documents").count()
    judged = [r for r in got if r.held_out and r.lang is not None]
    assert len(judged) > 100
    assert np.mean([r.lang == r.lang_pred for r in judged]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_grams_against_slices():
    for text in ["", "a", " ab ", L.letters("Ab, c9d_e été"), L.letters("xyz " * 50)]:
        bins, times = L.grams(text)
        grams = [text[i : i + n] for n in (1, 3, 4) for i in range(len(text) - n + 1)]
        assert times.sum() == len([g for g in grams if g != " "])
        seen: dict = {}
        for gram in grams:
            if gram != " ":
                own = L.grams(gram)
                seen[gram] = seen.get(gram, 0) + 1
                assert len(own[0]) >= 1
        assert len(bins) <= len(seen) or not len(bins)


def test_blocks_do_not_matter(monkeypatch):
    text = L.letters("the quick brown fox jumps " * 30)
    whole = L.grams(text)
    monkeypatch.setattr(L, "BLOCK", 7)
    parts = L.grams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_mixture_finds_shares():
    likelihood = np.array([[0.7, 0.2, 0.1], [0.1, 0.2, 0.7]])
    times = 1e4 * (np.array([0.3, 0.7]) @ likelihood)
    shares, _ = L.mixture(likelihood, times)
    for _ in range(30):
        mixed = shares @ likelihood
        shares = shares * (likelihood @ (times / mixed)) / times.sum()
    assert np.allclose(shares, [0.3, 0.7], atol=0.02)


def test_chosen_set_against_all_subsets(spark):
    texts = {"en": "the cat and the dog were there with them that night ", "de": "der hund und die katze sind noch immer nicht zuhause ",
             "fr": "le chat est dans une maison avec ses autres amis "}
    model = L.train(spark.createDataFrame([(t * 20, n) for n, t in texts.items()], "text string, lang string"))
    for names in ([n for n in texts], ["en"], ["de", "fr"], ["fr", "en"]):
        text = "".join(texts[n] * 8 for n in names)
        bins, times = L.grams(L.letters(text))
        likelihood = np.exp(model.logs[:, bins].astype(np.float64))
        worth = {}
        for size in (1, 2, 3):
            for some in itertools.combinations(range(3), size):
                shares = np.full(size, 1 / size)
                for _ in range(2000):
                    mixed = shares @ likelihood[list(some)]
                    shares = shares * (likelihood[list(some)] @ (times / mixed)) / times.sum()
                value = float(times @ np.log(shares @ likelihood[list(some)]))
                worth[some] = value - (size - 1) * L.PENALTY * np.log(times.sum() + 1), shares
        best = max(worth, key=lambda s: worth[s][0])
        guess = L.infer(text, model)
        assert set(guess.shares) == {model.languages[i] for i in best} == set(names)
        for i, share in zip(best, worth[best][1], strict=True):
            assert abs(guess.shares[model.languages[i]] - share) < 0.05
    # A third of the text in each language is no reason to reject it.
    mixed = spark.createDataFrame([("".join(t * 8 for t in texts.values()),)], "text string")
    assert L.predict(mixed, model, ()).where(L.accepted()).count() == 1


def test_edges(spark):
    rows = [(1, "the cat and the dog were there " * 5, "en"), (2, "der hund und die katze sind da " * 5, "de"),
            (3, None, "en"), (4, "", "en"), (5, "12 -- 34", None), (None, "the dog", None), (1, "the cat", "en")]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, c0 string, score double")
    model = L.train(docs.where("lang is not null"))
    assert model.languages == ["de", "en"]
    got = [(r.doc_id, r.lang_pred) for r in L.predict(docs, model, ("doc_id", "c0")).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en")], key=str
    )
    both = spark.createDataFrame([(9, rows[0][1] + rows[1][1])], "doc_id long, text string")
    mixed = L.predict(both, model).first()
    assert set(mixed.shares) == {"de", "en"} and 0.3 < mixed.score < 0.7
    assert L.predict(docs, model).where(L.accepted()).count() == 4
    nothing = L.train(docs.limit(0))
    assert [r.lang_pred for r in L.predict(docs, nothing).collect()] == ["und"] * len(rows)
    assert L.predict(docs.limit(0), model).collect() == []


def test_pieces(spark, monkeypatch):
    # All rows in order, each text whole; a run ends with the text that fills it.
    monkeypatch.setattr(common, "PIECE", 10)
    rows = [(0, "abcd"), (1, None), (2, "x" * 35), (3, ""), (4, "efgh"), (5, "ijklmnop"), (6, "q")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["n", "t"])
    got = [[tuple(r.values()) for r in p.to_pylist()] for p in common.pieces(iter([batch, batch.slice(3), batch.slice(0, 0)]), 1)]
    assert [r for p in got for r in p] == rows + rows[3:]
    assert all(sum(len(t or "") for _, t in p[:-1]) < 10 for p in got)
    assert [len(p) for p in got[:4]] == [3, 2, 1, 1]


def test_a_carried_text_is_sent_once(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de")],
                                 "doc_id long, text string, lang string")
    model = L.train(docs)
    found = L.predict(docs, model, ("doc_id", "text"))
    assert "AS t#" not in found._jdf.queryExecution().analyzed().toString()
    assert {(r.doc_id, r.text, r.lang_pred) for r in found.collect()} == {(r.doc_id, r.text, r.lang) for r in docs.collect()}
    # A text that is no string is cast for the reading and handed on as it was.
    other = L.predict(docs.withColumn("text", F.col("text").cast("binary")), model, ("text",))
    assert sorted((bytes(r.text).decode(), r.lang_pred) for r in other.collect()) == sorted((r.text, r.lang) for r in docs.collect())
