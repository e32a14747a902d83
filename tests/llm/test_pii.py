"""Personal data: base spans against Python's regular expressions, added spans on planted variants."""

import hashlib
import random
import re

import pytest

from acctlake.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text):
    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((m.start(), order, kind, m.end()))
    return sorted(spans)


def card(rng, parts=" "):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    digits += next(c for c in "0123456789" if luhn(digits + c))
    return parts.join(digits[i : i + 4] for i in range(0, 16, 4))


@pytest.mark.parametrize("seed", range(2))
def test_base_spans(spark, seed):
    rng = random.Random(seed)
    bits = ["a.b@x.com", "_d@e.fr", "@", "a@b", "a@b@c.d", "10.0.0.1", "256.1.1.1", "0001.02.3.4.5.6.7.8", "1.2.3", "+1 (456) 555-2186",
            "+12", "++49-30.123456", "4111 1111 1111 1111", "4111-1111-1111-1112", "é", "😀", " ", "-", ".", "9", "12", "\n", "abc", "%", "+"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "x a@b.c"), (903, "a@b.c"), (903, "a@b.c")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, base int")
    got = {}
    for r in P.digest(P.find(frame, P.NOTHING)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        spans = plain(text)
        joined = ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in spans)
        for row in got[i]:
            assert row.spans == joined, (text, row.spans)
            assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[2] == k for s in spans) for k in P.KINDS]
    assert sum(map(len, got.values())) == len(rows)


def test_long_texts(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1 " * 200_000, "+1" * 100_000, "1." * 100_000, "a@b." * 60_000, "a@b.c " * 20_000]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in P.digest(P.find(spark.createDataFrame(rows, "doc_id long, text string"), P.NOTHING)).collect()}
    for i, text in rows[2:]:
        spans = plain(text)
        assert got[i].spans == ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in spans), text[:10]
    assert got[0].spans == got[1].spans == ""


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 8)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def one(i):
        some = [f"{word()}.{word()}@{word()}.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card(rng, rng.choice([" ", "-", ""])),
                f"+1 ({digits(3)}) 555-{digits(4)}", f"{digits(3)} {digits(9)}{rng.randrange(10)}1", f"order {digits(9)}", "7.300.1.900"]
        return " ".join([*(word() for _ in range(15)), some[i % len(some)], *(word() for _ in range(15))])

    frame = spark.createDataFrame([(i, one(i)) for i in range(2000)], "doc_id long, text string")
    return P.train(frame), frame


def test_variants_are_added_and_clean_texts_left(spark, trained):
    model, frame = trained
    assert set(model.thresholds) == set(P.KINDS) and model.trees
    rng = random.Random(8)
    dotted = card(rng, ".")
    rows = [(1, f"he wrote to anna.berg (at) example (dot) com that day and paid with {dotted} at the shop"),
            (2, "nothing to see here at the end of the day, order 123 456 and 7.300.1.900 of it"),
            (3, "plain a.b@example.com and more of the same"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in P.digest(P.find(docs, model)).collect()}
    at = rows[0][1].index("anna")
    assert f"email:{at}:{at + len('anna.berg (at) example (dot) com')}" in got[1].spans
    assert f"card:{rows[0][1].index(dotted)}:{rows[0][1].index(dotted) + len(dotted)}" in got[1].spans
    assert [got[i].n_added for i in (2, 3, 4, 5)] == [0, 0, 0, 0]
    redacted = {r.doc_id: r.text for r in P.redact(docs, model).collect()}
    assert "anna" not in redacted[1] and dotted not in redacted[1] and len(redacted[1]) == len(rows[0][1])
    assert redacted[2] == rows[1][1] and redacted[4] is None and redacted[5] == ""
    assert P.find(frame, model).where("size(added) > 0").count() <= 100


def test_many_spelled_out_addresses(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(3, 8)))
    rows, spelled = [], set()
    for i in range(1500):
        at, dot = (" (at) ", " (dot) ") if i % 3 == 0 else ("@", ".")
        address = f"{word()}.{word()}{at}{word()}{dot}com"
        if i % 3 == 0:
            spelled.add(i)
        rest = f"{rng.randrange(300, 999)}.1.2.{rng.randrange(900)} {word()} {word()} at {word()}.{word()}"
        rows.append((i, " ".join([*(word() for _ in range(12)), address, *(word() for _ in range(12)), rest])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = P.train(docs)
    assert model.thresholds["email"] < 1
    found = {r.doc_id for r in P.digest(P.find(docs, model)).where("n_added > 0").collect()}
    assert len(spelled & found) >= 0.95 * len(spelled)
    assert len(found - spelled) <= 0.1 * len(found)


def test_nothing_to_learn(spark):
    for rows in ([], [(1, "no data at all")], [(1, "a@b.com only")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        model = P.train(docs)
        assert model == P.NOTHING
        assert P.find(docs, model).where("size(added) > 0").count() == 0


def test_plan_has_no_python(spark, trained):
    model, frame = trained
    plan = P.digest(P.find(frame, model))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_overlaps_without_limit(spark):
    model = P.Model([1.0], [1.0], {k: 0.0 for k in P.KINDS})
    rng = random.Random(5)
    numbers = ["".join(rng.choice("123456789") for _ in range(9)) for _ in range(60)]
    long = "_".join(numbers) + " at example.com"
    rows = [(1, long), (2, "call " + " and ".join(numbers)), (3, " ".join([long] * 200))]
    for r in P.find(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        spans = sorted((s.start, s.end) for s in r.added)
        assert spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        if r.doc_id == 1:
            assert spans == [(0, len(long))]
