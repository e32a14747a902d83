"""Language of documents by multilingual mixture inference.

Each language is a distribution over hashed letter n-grams, counted over all labelled texts. A document is
taken as a mixture: expectation-maximisation estimates the share of each language in its n-grams. The set of
languages is chosen by penalised likelihood: starting with the one that explains the text best, languages are added in order of
their estimated share as long as the log-likelihood grows by more than ``PENALTY`` times the logarithm of the
number of n-grams. The prediction is the language with the largest share.

Scale. Counting is one pass that sends at most languages x 2^GRAM_BITS sums a task; prediction is one pass
without a shuffle. The model's size depends only on the number of languages, which is checked
(``MAX_LANGUAGES``); nothing about documents is collected. Texts are handled one by one in blocks of letters, so memory
is bounded for very long ones. A batch is worked off in pieces of 1 MB of text, and a text that is handed on is sent to the task once.

Defined results. NULL texts and texts without a letter are ``und`` with score 0; so is every text if nothing was labelled.
Ties go to the language that is first by name. Repeated rows each get the same result. Empty tables give no rows. Further columns of the
input are not read by ``predict`` other than the carried ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from acctlake.llm.common import pieces, ship, stage

UNDETERMINED = "und"
#: N-grams of 1 to MAX_N letters are hashed to this many bits.
GRAM_BITS = 16
MAX_N = 4
#: Added to each count of an n-gram in a language.
SMOOTHING = 0.05
#: Log-likelihood that another language must bring, per logarithm of the number of n-grams.
PENALTY = 3.0
ITERATIONS = 12
#: More languages raise an error: the model is sent to all tasks.
MAX_LANGUAGES = 200
#: Letters that are hashed at a time.
BLOCK = 1 << 20

MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: languages x n-grams: logarithms of probabilities.
    logs: np.ndarray


def letters(text: str | None) -> str:
    """Lower-case words of letters, one space around each; empty without a letter."""
    found = " ".join(re.findall(r"[^\W\d_]+", (text or "").lower()))
    return f" {found} " if found else ""


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of ``letters`` and how often each occurs. Those of one letter that are a space are left out."""
    total = np.zeros(1 << GRAM_BITS, np.int64)
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at : at + BLOCK + MAX_N - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.uint64)
        limit = min(BLOCK, len(text) - at)
        mixed = np.zeros(len(codes), np.uint64)
        for n in range(1, MAX_N + 1):
            mixed = (mixed[: len(codes) - n + 1] * np.uint64(31)) ^ (codes[n - 1 :] * MULTIPLIERS[n - 1])
            if n == 2:
                continue
            hashed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x2545F4914F6CDD1D)
            keep = hashed[:limit]
            if n == 1:
                keep = keep[codes[: len(keep)] != 32]
            total += np.bincount((keep >> np.uint64(64 - GRAM_BITS)).astype(np.int64), minlength=1 << GRAM_BITS)
    present = np.flatnonzero(total)
    return present, total[present]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count the n-grams of all rows with a text and a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, 0):
            for content, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bins, times = grams(letters(content))
                if len(bins):
                    own = sums.setdefault(name, np.zeros(1 << GRAM_BITS, np.int64))
                    own[bins] += times
                    if len(sums) > MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, own in sums.items():
            bins = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(bins)), pa.array(bins.astype(np.int32)), pa.array(own[bins])], ["lang", "bin", "n"]
            )

    rows = labelled.select(F.col(text).cast("string"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    counted = stage(
        rows.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")),
        "grams",
    )
    languages = [r["lang"] for r in counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages.sort()
    counts = np.zeros((len(languages), 1 << GRAM_BITS))
    # At most languages x 2^GRAM_BITS rows, read part by part.
    for row in counted.toLocalIterator():
        counts[languages.index(row["lang"]), row["bin"]] = row["n"]
    smoothed = counts + SMOOTHING
    return Model(languages, np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32))


def mixture(likelihood: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the rows of ``likelihood`` (languages x n-grams) by expectation-maximisation, and the log-likelihood."""
    shares = np.full(len(likelihood), 1 / len(likelihood))
    total = times.sum()
    for _ in range(ITERATIONS):
        mixed = shares @ likelihood
        shares = shares * (likelihood @ (times / mixed)) / total
    return shares, float(times @ np.log(shares @ likelihood))


@dataclass(frozen=True)
class Guess:
    lang: str
    score: float
    #: Share of each language of the chosen set, largest first.
    shares: dict[str, float]
    #: Mean log-likelihood of an n-gram above that of all n-grams being equally likely.
    fit: float


NOTHING = Guess(UNDETERMINED, 0.0, {}, 0.0)


def infer(text: str | None, model: Model) -> Guess:
    bins, times = grams(letters(text))
    if not len(bins) or not model.languages:
        return NOTHING
    times = times.astype(np.float64)
    logs = model.logs[:, bins].astype(np.float64)
    single = logs @ times
    best = int(np.argmax(single))
    # The largest value of an n-gram is taken out so that the exponentials stay in range.
    top = logs.max(axis=0)
    likelihood = np.exp(logs - top)
    shift = float(times @ top)
    order = [best]
    if len(single) > 1:
        shares, _ = mixture(likelihood, times)
        order += [int(i) for i in np.argsort(-shares, kind="stable") if i != best]
    chosen, found, reached = [best], np.ones(1), float(single[best])
    penalty = PENALTY * np.log(times.sum() + 1)
    for n in range(2, len(order) + 1):
        shares, value = mixture(likelihood[order[:n]], times)
        if value + shift - reached <= penalty:
            break
        chosen, found, reached = order[:n], shares, value + shift
    ranked = sorted(zip(found, chosen, strict=True), key=lambda x: (-x[0], x[1]))
    share, winner = ranked[0]
    rival = max((single[i] for i in range(len(single)) if i != winner), default=-np.inf)
    # Of a single language: how far it is ahead of the next; of several: their shares say it.
    ahead = 1.0 if len(chosen) > 1 else 1 - np.exp(-max(0.0, float(single[winner] - rival)))
    fit = reached / times.sum() + GRAM_BITS * np.log(2)
    return Guess(
        model.languages[winner], float(min(1.0, max(0.0, share * ahead))),
        {model.languages[i]: float(s) for s, i in ranked}, float(fit),
    )


def predict(docs: DataFrame, model: Model, carried: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``carried`` columns with ``lang_pred, score, shares, fit`` of each text; nothing but the text is looked at."""
    names = [f"c{i}" for i in range(len(carried))]
    kept = docs.select(*[F.col(c).alias(n) for c, n in zip(carried, names, strict=True)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    if text in carried and kept.schema[at := list(carried).index(text)].dataType == StringType():
        sent = kept
    else:
        at, sent = len(names), docs.select(
            *[F.col(c).alias(n) for c, n in zip(carried, names, strict=True)], F.col(text).cast("string").alias("t")
        )
    results = "lang_pred string, score double, shares map<string,double>, fit double"
    kinds = [pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()), pa.float64()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            guesses = [infer(t, model) for t in batch.column(at).to_pylist()]
            columns = list(zip(*((g.lang, g.score, list(g.shares.items()), g.fit) for g in guesses), strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                batch.columns[: len(names)] + [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                [*names, "lang_pred", "score", "shares", "fit"],
            )

    found = sent.mapInArrow(each, f"{schema}, {results}" if names else results)
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, carried, strict=True)], "lang_pred", "score", "shares", "fit"
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training; a NULL id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))) % 4 == 2


def accepted() -> Column:
    """Rows of ``predict`` that a corpus keeps: the text has a letter, and the languages found explain its n-grams better than
    chance. How the text is divided among them does not matter."""
    return (F.col("lang_pred") != UNDETERMINED) & (F.col("fit") > 0)


ship(__name__)
