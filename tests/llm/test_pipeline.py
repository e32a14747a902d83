"""The pipeline: stages one by one on planted documents, and run() against the stages' own rules."""

import random

import corpus_pipeline as C
from acctlake.llm.simhash import fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FILLER = {"en": "the of and to in is that it was for on are with they this from have".split(),
          "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein".split()}


def prose(rng, lang, n):
    return " ".join(rng.choice(FILLER[lang]) + rng.choice(["", "", rng.choice("aeiou") + rng.choice("lnrst")]) for _ in range(n))


def planted(spark, folder):
    rng = random.Random(11)
    rows = []
    for i in range(120):
        lang = "de" if i % 3 == 0 else "en"
        rows.append((i, "\n".join(prose(rng, lang, 40) for _ in range(4)), lang, f"s{i % 4}"))
    passage = prose(rng, "en", 60)
    item = prose(rng, "en", 30)
    rows += [(200 + i, prose(rng, "en", 120) + "\n" + passage, "en", "s1") for i in range(3)]
    rows += [(300, rows[5][1], "en", "s2"), (301, "12 34 ---", "en", "s2"), (302, None, None, None), (303, "", "en", None)]
    one = prose(rng, "en", 400).split()
    rows += [(310, " ".join(one), "en", "s3"), (311, " ".join([*one[:-1], "altered"]), "en", "s3")]
    words = item.split()
    words[10] = words[20] = "swapped"
    rows += [(320, prose(rng, "en", 50) + " " + " ".join(words) + " " + prose(rng, "en", 50), "en", "s0")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {r[0]: r for r in rows}, passage


def test_planted_documents(spark, tmp_path):
    rows, passage = planted(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = [sorted(r.doc_id for r in docs.select("doc_id").collect())]
    texts = {}
    for n, (_, function) in enumerate(C.STAGES):
        out = function(spark, docs, str(tmp_path))
        if n < len(C.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        texts = {r.doc_id: r.text for r in docs.collect()}
        seen.append(sorted(texts))
        if n == 1:
            assert passage in texts[200] and passage not in texts[201] and passage not in texts[202]
            assert {r.doc_id for r in docs.where("n_chars <> length(text)").collect()} == set()
        if n == 2:
            assert len({fingerprint(t) for t in texts.values()}) == len(texts)
    gone = [set(a) - set(b) for a, b in zip(seen, seen[1:])]
    assert gone[0] == {301, 302, 303}
    assert gone[1] == {300}
    assert gone[2] == {311}
    assert gone[3] == {320}
    assert {"size", "source_size", "target", "taken"} <= set(docs.columns)
    mixed = docs.collect()
    assert all(r.taken in (r.size, 2 * r.size) and r.taken > 0 for r in mixed)
    whole = sum(len(texts_.split()) for texts_ in
                {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/3").collect()}.values())
    assert 0.9 * 1.5 * whole < sum(r.taken for r in mixed) <= 1.5 * whole

    again = {(r.doc_id, r.taken) for r in C.run(spark, str(tmp_path)).collect()}
    assert again == {(r.doc_id, r.taken) for r in mixed}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_and_clashing_names(spark, tmp_path):
    rows = [(1, "the cat and the dog of the house were here and there", "en", "a", 1, 2, "x")] * 3
    rows += [(None, "a bird was in the tree and it sang to them all day long", "en", None, 1, 2, "x")] * 2
    rows += [(1, "quite some other words of the same number stand in this one", "en", "a", 1, 2, "x")]
    schema = SCHEMA.replace("n_chars long", "size int, taken int, key string")
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = C.run(spark, str(tmp_path)).collect()
    assert 1 <= len(got) <= 3 and len({r.text for r in got}) == len(got)
    assert {r.key for r in got} == {"x"}
