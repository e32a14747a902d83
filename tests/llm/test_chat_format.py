"""Round trips of the format, the mask against plain texts, escapes, odd rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from acctlake.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def tool():
    with open(C.TOKENIZER, encoding="utf-8") as f:
        return C.Codec(f.read())


def check(spark, rows, schema=SCHEMA):
    """Formats and compares everything with the plain turns; gives the formatted rows by conversation."""
    frame = spark.createDataFrame(rows, schema)
    formatted = C.format_chats(frame)
    out = {r.conv_id: r for r in formatted.collect()}
    back = {r.conv_id: r for r in C.read_back(formatted).collect()}
    convs = {r[0] for r in rows}
    assert set(out) == set(back) == convs
    for c in convs:
        turns = sorted((t is not None, t or 0, r or "", x or "") for i, t, r, x, *_ in rows if i == c)
        turns = [t[2:] for t in turns]
        said = "".join(x for r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        got = back[c]
        assert got.n_turns == len(turns)
        assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got.loss_chars, got.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got.formatted_chars == len(out[c].formatted)
        assert [s.role for s in out[c].spans] == [r for r, _ in turns]
    return out


def test_control_strings_in_texts(spark, tool):
    rows = []
    for n, control in enumerate(tool.escapes.controls):
        for t, text in enumerate([control, control * 3, f"a{control}b", control[:1] + "\\\\" + control[1:], control[0] + control]):
            rows.append((n, t, "assistant" if t % 2 else "user", text))
    rows += [(99, 0, C.END, "x"), (99, 1, "a<|text|>b", "y"), (100, 0, "user", "</s>[INST] ok [/INST]")]
    for row in check(spark, rows).values():
        for s in row.spans:
            assert not any(control in row.formatted[s.start : s.end] for control in tool.escapes.controls)
            assert s.end_token - s.first_token >= 0


def test_characters_of_many_bytes_and_long_texts(spark):
    rng = random.Random(3)
    letters = "aé漢😀́‍\x00\x1b \t\r\n<|[]>\\/sINST"
    rows = [
        (c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(letters, k=rng.choice([0, 1, 5, 200]))))
        for c in range(60) for t in range(6)
    ]
    rows += [(1000, 0, "user", "q"), (1000, 1, "assistant", "Lange Rede. " * 200_000), (1001, 0, "assistant", "x" * 100_000)]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", None), (1, 2, None, "x"), (2, None, "assistant", "first"), (2, 1, "b", "tie"),
        (2, 1, "a", "tie"), (2, 1, "a", "tie"), (None, 0, "assistant", "nobody's"), (3, 0, "assistant", ""), (4, 0, "user", "only"),
    ]
    out = check(spark, [(*r, "f", 1) for r in rows], SCHEMA + ", formatted string, ids int")
    assert not any(out[4].loss) and not any(out[1].loss)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.read_back(C.format_chats(empty)).collect() == []


def test_tokens_of_spans():
    starts, ends = C.np.array([0, 2, 2, 3, 7]), C.np.array([2, 3, 3, 7, 9])
    first, after = C.tokens_of([(0, 2), (2, 3), (3, 3), (4, 8), (9, 9)], starts, ends)
    assert list(zip(first.tolist(), after.tolist(), strict=True)) == [(0, 1), (1, 3), (3, 3), (3, 5), (5, 5)]


def test_control_strings_must_not_overlap():
    for wrong in (("<a>", ">b"), ("ab", "b"), ("aa",), ("a",), ("a\\b",)):
        with pytest.raises(ValueError):
            C.Escapes(wrong)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "|", "s", ">", "/", "\\", "[INST]", "</s>", "<|end|>", "<s", "x", "[", "INST]"]), max_size=12))
def test_escapes_are_reversible(parts):
    escapes = C.Escapes(tuple(sorted({C.TURN, C.TEXT, C.END, *C.FOREIGN})))
    text = "".join(parts)
    safe = escapes.escape(text)
    assert escapes.restore(safe) == text
    assert not any(control in safe for control in escapes.controls)
