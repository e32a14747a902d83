"""Conversations as token ids with a loss mask: each is rendered whole and encoded once, and the mask comes from offsets.

Rendering notes where each turn's text begins and ends. The encoder gives every token's range of characters, in order as the turns are, so
two binary searches a turn find the tokens that meet it. The template's markers are tokens of their own, which no other token can
overlap; a token therefore never holds a part of two turns, and the mask covers a learned text exactly.

Control strings (markers, the tokenizer's special tokens and ``FOREIGN``) inside roles and texts get ``ESCAPE`` after their first character; where
there are such characters already, one more. No control string may begin inside another, so their places never overlap and one
replacement each way is exact.

Scale. Rows are gathered by conversation in one shuffle; each conversation is rendered, encoded and read back by itself, with batches that are
bounded by their characters. The tokenizer's file is read once, at the driver, and sent to the tasks. A conversation is the unit of work, as
it has to be encoded in one piece: one task holds the texts of one conversation.

Defined results. Turns are ordered by turn, NULL first, ties by role and text. NULL roles and texts are empty; rows with a NULL conv_id are one
conversation. Repeated rows are turns of their own. A conversation without a learned turn has no learned token. Empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import ship

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Markers: before a role, between role and text, after a text.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPE = "\\"
#: Control strings of usual templates (fixed values).
FOREIGN = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>",
)
LEARNED = ("assistant",)
#: Characters that are encoded, and tokens that are sent on, at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Escapes:
    """Makes control strings in a text harmless, and restores them."""

    controls: tuple[str, ...]

    def __post_init__(self) -> None:
        for one in self.controls:
            if len(one) < 2 or ESCAPE in one:
                raise ValueError(f"a control string has two characters or more and no {ESCAPE!r}: {one!r}")
            for other in self.controls:
                if any(other.startswith(one[at:]) or one[at:].startswith(other) for at in range(1, len(one))):
                    raise ValueError(f"{other!r} can begin inside {one!r}")

    @cached_property
    def places(self) -> tuple[re.Pattern, re.Pattern]:
        """First characters of control strings, also of such that are escaped; the same with the escape that goes."""
        rests: dict[str, list[str]] = {}
        for one in sorted(set(self.controls)):
            rests.setdefault(one[0], []).append(re.escape(one[1:]))
        kept = re.escape(ESCAPE)
        kinds = [(re.escape(first), f"(?={kept}*(?:{'|'.join(rest)}))") for first, rest in rests.items()]
        return re.compile("|".join(f + r for f, r in kinds)), re.compile("|".join(f + kept + r for f, r in kinds))

    def escape(self, text: str) -> str:
        return self.places[0].sub(lambda m: m[0] + ESCAPE, text)

    def restore(self, text: str) -> str:
        return self.places[1].sub(lambda m: m[0][:-1], text)


def render(turns: Sequence[tuple[str, str]], escapes: Escapes) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation and the range of characters of each turn's escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escapes.escape(role)}{TEXT}", escapes.escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
        parts += [head, body, END]
    return "".join(parts), spans


def tokens_of(spans: Sequence[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span the first token that meets it and the one after the last; both sides are sorted."""
    wanted = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(ends, wanted[:, 0], "right")
    return first, np.maximum(first, np.searchsorted(starts, wanted[:, 1], "left"))


class Codec:
    """A tokenizer with the template's markers as tokens of their own."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.tokenizer.add_special_tokens([TURN, TEXT, END])
        self.escapes = Escapes(tuple(sorted({TURN, TEXT, END, *special, *FOREIGN})))
        self.turn, self.text, self.end = (self.tokenizer.token_to_id(m) for m in (TURN, TEXT, END))

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, and where each token's characters start and end."""
        for one in self.tokenizer.encode_batch(list(texts), add_special_tokens=False):
            offsets = np.array(one.offsets, np.int64).reshape(-1, 2)
            yield np.array(one.ids, np.int32), offsets[:, 0], offsets[:, 1]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def turns(self, ids: np.ndarray) -> list[tuple[str, str]]:
        """Roles and texts out of the ids of a rendered conversation."""
        found = []
        for start, middle, end in zip(*(np.flatnonzero(ids == m) for m in (self.turn, self.text, self.end)), strict=True):
            role, text = self.decode(ids[start + 1 : middle]), self.decode(ids[middle + 1 : end])
            found.append((self.escapes.restore(role), self.escapes.restore(text)))
        return found

    def learned(self, ids: np.ndarray, mask: np.ndarray) -> str:
        """All text under the mask; each run of masked tokens is restored by itself."""
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
        return "".join(self.escapes.restore(self.decode(ids[a:b])) for a, b in edges.reshape(-1, 2))


_CODECS: dict[str, Codec] = {}


def codec(definition: str) -> Codec:
    """One per worker process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(definition)
    return _CODECS[key]


def format_chats(
    conversations: DataFrame, tokenizer: str = TOKENIZER, learned: Sequence[str] = LEARNED, conv_id: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv_id, formatted, ids, loss, spans`` per conversation.

    ``loss`` has a flag per token; ``spans`` has each turn's role, range of characters in ``formatted`` and range of tokens.
    """
    definition = Path(tokenizer).read_text(encoding="utf-8")
    wanted = frozenset(learned)
    span = pa.struct([
        ("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("first_token", pa.int32()), ("end_token", pa.int32()),
    ])
    names = ["conv_id", "formatted", "ids", "loss", "spans"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(definition)

        def block(convs: list, talks: list, rendered: list) -> pa.RecordBatch:
            ids, loss, places = [], [], []
            for turns, (_, spans), (tokens, starts, ends) in zip(talks, rendered, tool.encode([r[0] for r in rendered]), strict=True):
                first, after = tokens_of(spans, starts, ends)
                mask = np.zeros(len(tokens), bool)
                for (name, _), a, b in zip(turns, first, after, strict=True):
                    if name in wanted:
                        mask[a:b] = True
                ids.append(tokens)
                loss.append(mask)
                places.append([
                    {"role": name, "start": s, "end": e, "first_token": a, "end_token": b}
                    for (name, _), (s, e), a, b in zip(turns, spans, first.tolist(), after.tolist(), strict=True)
                ])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(convs, pa.int64()), pa.array([r[0] for r in rendered]), pa.array(ids, pa.list_(pa.int32())),
                    pa.array(loss, pa.list_(pa.bool_())), pa.array(places, pa.list_(span)),
                ],
                names,
            )

        convs, talks, rendered, held = [], [], [], 0
        for batch in batches:
            for n in range(batch.num_rows):
                turns = [(t["role"], t["text"]) for t in batch.column(1)[n].as_py()]
                rendered.append(render(turns, tool.escapes))
                convs.append(batch.column(0)[n].as_py())
                talks.append(turns)
                held += len(rendered[-1][0])
                if held >= BLOCK:
                    yield block(convs, talks, rendered)
                    convs, talks, rendered, held = [], [], [], 0
        if convs:
            yield block(convs, talks, rendered)

    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    turns = gathered.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("t"))
    schema = (
        "conv_id long, formatted string, ids array<int>, loss array<boolean>, "
        "spans array<struct<role: string, start: int, end: int, first_token: int, end_token: int>>"
    )
    return turns.mapInArrow(each, schema)


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What the ids and the mask hold, as digests: turns, learned text and characters, all decoded and restored."""
    definition = Path(tokenizer).read_text(encoding="utf-8")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(definition)
        for batch in batches:
            rows = []
            for n in range(batch.num_rows):
                ids = batch.column(1)[n].values.to_numpy(zero_copy_only=False)
                mask = batch.column(2)[n].values.to_numpy(zero_copy_only=False)
                turns, text = tool.turns(ids), tool.learned(ids, mask)
                whole = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                digest = hashlib.sha256(text.encode()).hexdigest()
                rows.append((len(turns), whole.hexdigest(), len(text), digest, len(tool.decode(ids))))
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in columns]], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "ids", "loss").mapInArrow(each, schema)


ship(__name__)
