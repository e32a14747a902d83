"""Ordinal regression: gradients, held-out labels, planted words, odd rows."""

import numpy as np

from acctlake.llm import toxicity as T
from acctlake.llm.common import table


def test_fit_recovers_order():
    rng = np.random.default_rng(1)
    n, size = 4000, 6
    x = rng.random((n, size))
    weights, cuts = np.array([4.0, -3.0, 2.0, 0, 0, 0]), np.array([0.5, 2.0, 3.5])
    noise = rng.logistic(size=n)
    grade = np.searchsorted(cuts, x @ weights + noise)
    row, at = np.nonzero(x)
    got, thresholds = T.fit_ordinal(row, at, x[row, at], grade, size, 4)
    assert (np.diff(thresholds) > 0).all()
    assert np.allclose(got, weights, atol=0.8) and np.allclose(thresholds, cuts, atol=0.8)


def test_held_out_labels(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = T.fit(T.labelled_texts(docs, labels.where("doc_id % 3 <> 0")))
    judged = T.predict(docs, model).drop("toxic").join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    toxic = judged.toxic == 1
    assert toxic.sum() > 50
    assert (judged.p_toxic[~toxic] < 0.5).mean() > 0.98
    assert (judged.p_toxic[toxic] > 0.5).mean() > 0.75
    assert judged.severity[toxic].mean() > 1 > judged.severity[~toxic].mean()
    assert np.allclose(judged.severity, [np.dot(g, range(T.GRADES)) for g in judged.grades])


def test_planted_and_odd_rows(spark):
    rows = [(i, f"good words of day {i % 7} and night " * 3, 0) for i in range(60)]
    rows += [(100 + i, f"you vile{'xyz'[i % 3]} thing of day {i % 7}" + " vilest" * (i % 5), 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t, _ in rows], "doc_id long, text string, f int, label string")
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(None, 1), (7777, 1), (3, None), (100, 0), (100, 1)], "doc_id long, toxic int"
    )
    model = T.fit(T.labelled_texts(docs, labels))
    assert (np.diff(model.thresholds) > 0).all()
    new = spark.createDataFrame(
        [(1, "a vileness"), (2, "a good day"), (3, None), (4, ""), (None, "vile " * 2000), (1, "a vileness")], "doc_id long, text string"
    )
    got = {(r.doc_id, r.toxic) for r in T.predict(new, model).collect()}
    assert got == {(1, True), (2, False), (3, False), (4, False), (None, True)}
    assert T.predict(new.limit(0), model).collect() == []
    for none in (labels.limit(0), labels.where("toxic = 0")):
        bare = T.fit(T.labelled_texts(docs, none))
        assert {r.severity < 1e-9 for r in T.predict(new, bare).collect()} == {True}
