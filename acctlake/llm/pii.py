"""Personal data: spans by fixed patterns, and more of them by boosted trees on proposed candidates.

The base patterns find e-mail addresses, IP addresses, payment cards and phone numbers; these spans always stay. Wider generators
propose further, overlapping candidates in the rest of the text (spelled-out or bracketed signs, other separators, no leading plus).
Gradient-boosted trees judge each by its format and context. They learn from base spans against matches and candidates that fail a
check of their kind (check digit, parts over 255, number of digits, names of domains, context); a candidate that passes may be another spelling and is
neither right nor wrong. The features don't tell the spelling apart, so what looks and stands like personal data scores like it. For each kind a threshold is calibrated on documents that were not learned from: the lowest with the wanted precision.

Only DataFrame functions run on documents: matches, positions, features and trees are expressions on one row, so
there is no shuffle, and no document depends on another. Positions are running sums in two levels, linear in the number of
matches. The patterns are written so that no text makes them backtrack without end: quantifiers are possessive where the
pattern allows it, and a match can only begin where a run of characters does.

The trees are fitted on about ``TRAINING_DOCS`` different texts, chosen by their hash (a documented bound); thresholds come from all documents that
were not fitted on, and everything else covers all.

Defined results. NULL text: no spans. Positions are code points, ends exclusive. Repeated rows each get the same result. If there is nothing to learn from (no base spans
or nothing that fails a check), nothing is added. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
# The base patterns. As written in the description they are
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ; [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) ;
# [0-9]([\x20-]?[0-9])+ ; \+[0-9][\x20().0-9-]+[0-9]
# \G lets a match begin right after the one before, in the middle of a run.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"\x20?(?:@|[(\[{<]\x20?at\x20?[)\]}>])\x20?|\x20at\x20"
_DOT = r"\x20?(?:[(\[{<]\x20?(?:dot|\.)\x20?[)\]}>])\x20?|\x20dot\x20|\."
# Candidates that the base patterns don't see.
WIDE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:{_AT})[A-Za-z0-9-]++(?:(?:{_DOT})[A-Za-z0-9-]++)++",
    "ip": rf"(?<![A-Za-z0-9.])[0-9]{{1,3}}+(?:(?:{_DOT})[0-9]{{1,3}}+){{3}}(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9](?:[\x20._/-]{0,2}+[0-9]){11,18}+(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9])\(?+[0-9](?:[\x20()./-]{0,2}+[0-9]){8,14}+(?![A-Za-z0-9])",
}
#: A text without any of these has no candidates.
SIGNS = rf"[0-9@]|[(\[{{<]\x20?at\x20?[)\]}}>]|\x20dot\x20"
SPANS = "array<struct<kind:string,m:string,start:int,end:int,before:string,after:string>>"
ADDED = "struct<start:int,kind:int,end:int,score:double>"
#: Words near a span that speak for a kind.
CONTEXT_WORDS = {
    "mail_word": r"(?i)mail|contact|write|correo|courriel|kontakt",
    "net_word": r"(?i)\bip\b|host|server|address|login|adresse|direcci",
    "card_word": r"(?i)card|visa|credit|master|payment|karte|carte|tarjeta",
    "call_word": r"(?i)phone|\btel|call|mobile|fax|telefon|appel|llam",
}
CHUNK = 128
BEFORE, AFTER = 32, 12
TRAINING_DOCS = 40_000
TREES, DEPTH = 12, 4
PRECISION = 0.9
SEED = 7


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of ``kind, m, start, end, before, after`` of all matches, leftmost first."""

    def spans(parts: Column) -> Column:
        gaps, found = parts["gaps"], parts["found"]
        lengths = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
        return let(
            F.struct(gaps.alias("gaps"), found.alias("found"), lengths.alias("lengths")),
            lambda p: let(
                F.struct(p["gaps"].alias("gaps"), p["found"].alias("found"), p["lengths"].alias("lengths"), _chunk_sums(p["lengths"]).alias("sums")),
                placed,
            ),
        )

    def placed(p: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            chunk = F.floor(i / CHUNK).cast("int")
            before = _sum(F.slice(p["sums"], 1, chunk)) + _sum(F.slice(p["lengths"], chunk * CHUNK + 1, i % CHUNK))
            gap = F.get(p["gaps"], i)
            start = before + F.length(gap)
            return F.struct(
                F.lit(kind).alias("kind"), m.alias("m"), start.alias("start"), (start + F.length(m)).alias("end"),
                F.right(gap, F.lit(BEFORE)).alias("before"), F.left(F.get(p["gaps"], i + 1), F.lit(AFTER)).alias("after"),
            )

        return F.transform(p["found"], one)

    return F.when(text.rlike(pattern), let(_parts(text, pattern), spans)).otherwise(F.array().cast(SPANS))


def _parts(text: Column, pattern: str) -> Column:
    """The matches of a pattern and what stands between them."""
    return F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _chunk_sums(numbers: Column) -> Column:
    chunks = F.ceil(F.size(numbers) / CHUNK).cast("int")
    return F.when(
        chunks > 0, F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: _sum(F.slice(numbers, c * CHUNK + 1, CHUNK)))
    ).otherwise(F.array().cast("array<int>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right; of text of 1 to 19 digits."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def small_parts(numbers: Column) -> Column:
    """Whether all texts of digits are at most 255."""

    def ok(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(bare) > 3, False).otherwise(F.concat(F.lit("0"), F.substring(bare, 1, 3)).cast("int") <= 255)

    return F.forall(numbers, ok)


def valid(kind: str, m: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "ip":
        return small_parts(F.split(m, r"\."))
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans, by kind."""
    def of(kind: str) -> Column:
        return F.filter(matches(text, kind, BASE[kind]), lambda s: valid(kind, s["m"]))

    # Most texts have no such character: one look at them instead of a search per kind.
    return F.when(text.rlike("[0-9@]"), F.concat(*map(of, KINDS))).otherwise(F.array().cast(SPANS))


def _masked(text: Column) -> Column:
    """The text with base spans blanked out, of the same length."""
    covered = text
    for kind in KINDS:
        covered = _blanked(covered, kind)
    return F.when(text.rlike("[0-9@]"), covered).otherwise(text)


def _blanked(text: Column, kind: str) -> Column:
    def covered(m: Column) -> Column:
        return F.when((m != "") & valid(kind, m), F.repeat(F.lit("\x01"), F.length(m))).otherwise(m)

    def blank(parts: Column) -> Column:
        kept = F.transform(
            parts["gaps"], lambda gap, i: F.concat(gap, let(F.coalesce(F.get(parts["found"], i), F.lit("")), covered))
        )
        return F.array_join(kept, "")

    pattern = BASE[kind]
    return let(text, lambda t: F.when(t.rlike(pattern), let(_parts(t, pattern), blank)).otherwise(t))


def wide_spans(masked: Column) -> Column:
    """Candidates of all generators."""
    return let(
        masked, lambda t: F.when(t.rlike(SIGNS), F.concat(*[matches(t, k, WIDE[k]) for k in KINDS])).otherwise(F.array().cast(SPANS))
    )


def failing(s: Column) -> Column:
    """Whether a wide candidate fails a check of its kind."""
    around = F.concat(s["before"], F.lit(" "), s["after"])
    last = F.regexp_extract(s["m"], r"([A-Za-z0-9-]*)\z", 1)
    # "look at this.that" is a sentence unless mail is spoken of.
    bare = s["m"].rlike(r"\x20at\x20[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\z")
    digits = _digits(s["m"])
    return (
        F.when(s["kind"] == "email", ~last.rlike(r"\A[A-Za-z]{2,24}\z") | (bare & ~around.rlike(CONTEXT_WORDS["mail_word"])))
        .when(s["kind"] == "ip", ~small_parts(F.regexp_extract_all(s["m"], F.lit("[0-9]+"), F.lit(0))))
        .when(s["kind"] == "card", ~F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False))
        .otherwise(~F.length(digits).between(9, 15) | ~around.rlike(CONTEXT_WORDS["call_word"]))
    )


def invalid_spans(text: Column) -> Column:
    """Base matches that don't count, of the kinds whose wide generator does not propose them all."""
    of = lambda kind: F.filter(matches(text, kind, BASE[kind]), lambda s: ~valid(kind, s["m"]))
    return F.when(text.rlike("[0-9]"), F.concat(of("ip"), of("phone"))).otherwise(F.array().cast(SPANS))


def features(s: Column) -> dict[str, Column]:
    """Format and context of a span; none tells the spelling of a sign or separator."""
    m = s["m"]
    # Spelled-out signs count as the sign.
    plain = F.regexp_replace(F.regexp_replace(m, f"(?:{_AT})", "@"), f"(?:{_DOT})", ".")
    digits = _digits(m)
    flag = lambda c: c.cast("double")
    around = F.concat(s["before"], F.lit(" "), s["after"])
    return {
        "kind": F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("double"),
        "length": F.length(plain).cast("double"),
        "digits": F.length(digits).cast("double"),
        "letters": F.length(F.regexp_replace(plain, "[^A-Za-z]", "")).cast("double"),
        "groups": F.size(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))).cast("double"),
        "different": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "dots": (F.length(plain) - F.length(F.replace(plain, F.lit("."), F.lit("")))).cast("double"),
        "check": flag(F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)),
        "small": flag(small_parts(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)))),
        "last_letters": F.length(F.regexp_extract(plain, r"([A-Za-z]*)\z", 1)).cast("double"),
        "apart": flag(s["before"].rlike(r"(?:\A|[\s,;:.(\[\x01])\z")),
        "ends": flag(s["after"].rlike(r"\A(?:\z|[\s,;:.)\]\x01])")),
        **{name: flag(around.rlike(pattern)) for name, pattern in CONTEXT_WORDS.items()},
    }


@dataclass(frozen=True)
class Model:
    """Trees as nested (feature, threshold, left, right) with numbers as leaves, their weights, and a threshold per kind."""

    trees: list
    weights: list[float]
    thresholds: dict[str, float]


NOTHING = Model([], [], dict.fromkeys(KINDS, 2.0))


def _labelled(texts: DataFrame, t: Column) -> DataFrame:
    """``label, s``: base spans (1) and candidates that fail a check of their kind (0)."""
    return texts.select(F.explode(F.concat(
        F.transform(base_spans(t), lambda s: F.struct(F.lit(1.0).alias("label"), s.alias("s"))),
        F.transform(
            F.array_distinct(F.concat(F.filter(wide_spans(_masked(t)), failing), invalid_spans(t))),
            lambda s: F.struct(F.lit(0.0).alias("label"), s.alias("s")),
        ),
    )).alias("x")).select("x.label", "x.s")


def train(docs: DataFrame, text: str = "text") -> Model:
    """Trees fitted on at most about ``TRAINING_DOCS`` different texts; thresholds from all documents that were not fitted on."""
    total = docs.count()
    share = min(1.0, TRAINING_DOCS / max(1, total))
    chosen = F.xxhash64(F.lit(SEED), "t")
    part = chosen.bitwiseAND(F.lit((1 << 30) - 1))
    held = F.shiftrightunsigned(chosen, 40) % 4 == 0
    in_sample = part < int(share * (1 << 30))
    texts = docs.select(F.col(text).cast("string").alias("t")).where("t is not null")
    sample = texts.where(in_sample)
    # A text that very many rows share is one text to learn from.
    sample = sample.distinct()
    spans = stage(_labelled(sample.where(~held), F.col("t")), "spans")
    found = features(F.col("s"))
    learned = stage(spans.select("label", *[c.alias(n) for n, c in found.items()]), "features").coalesce(4)
    if learned.select("label").distinct().count() < 2:
        return NOTHING
    vectors = VectorAssembler(inputCols=list(found), outputCol="features")
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxBins=32).fit(
        vectors.transform(learned.repartition(4, *found))
    )
    names = list(found)
    trees = [_tree(t._java_obj.rootNode(), names) for t in fitted.trees]
    model = Model(trees, list(fitted.treeWeights), {})
    others = _labelled(texts.where(~in_sample | held), F.col("t"))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("s.kind")).cast("int")
    # Whole thousandths: at most 1001 rows per kind.
    bins = (
        others.select(number.alias("kind"), "label", F.floor(score(F.col("s"), model) * 1000).alias("bin"))
        .groupBy("kind", "bin").agg(F.sum("label").alias("right"), F.count("*").alias("all"))
        .collect()
    )
    thresholds = {}
    for number, kind in enumerate(KINDS, 1):
        right = every = 0.0
        thresholds[kind] = 2.0
        for row in sorted((b for b in bins if b["kind"] == number and b["bin"] >= 500), key=lambda b: -b["bin"]):
            right, every = right + row["right"], every + row["all"]
            if right / every >= PRECISION:
                thresholds[kind] = row["bin"] / 1000
    return replace(model, thresholds=thresholds)


def _tree(node, names: list[str]):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (names[split.featureIndex()], float(split.threshold()), _tree(node.leftChild(), names), _tree(node.rightChild(), names))


def _leaf(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    name, limit, left, right = tree
    return F.when(f[name] <= limit, _leaf(left, f)).otherwise(_leaf(right, f))


def score(s: Column, model: Model) -> Column:
    """Probability of a candidate."""

    def margin(f: Column) -> Column:
        total = F.lit(0.0)
        for tree, weight in zip(model.trees, model.weights, strict=True):
            total = total + _leaf(tree, f) * weight
        return 1 / (1 + F.exp(total * -2))

    return let(F.struct(*[c.alias(n) for n, c in features(s).items()]), margin)


def added_spans(text: Column, model: Model) -> Column:
    """Candidates above the threshold of their kind. From left to right, of two that overlap the better one stays, that of the
    first kind and start if equal; so no two of the result overlap, however many a text has."""
    if not model.trees:
        return F.array().cast(f"array<{ADDED}>")
    limits = F.create_map(*[F.lit(x) for kv in model.thresholds.items() for x in kv])
    judged = F.transform(
        wide_spans(_masked(text)),
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("kind"),
            s["end"].alias("end"), score(s, model).alias("score"), F.element_at(limits, s["kind"]).alias("limit"),
        ),
    )
    passed = F.array_sort(F.transform(
        F.filter(judged, lambda s: s["score"] >= s["limit"]),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["score"].alias("score")),
    ))

    def step(acc: Column, s: Column) -> Column:
        last = acc["last"]
        apart = last.isNull() | (last["end"] <= s["start"])
        better = (s["score"] > last["score"]) | (
            (s["score"] == last["score"]) & (F.struct(s["kind"], s["start"]) < F.struct(last["kind"], last["start"]))
        )
        return F.struct(
            F.when(apart & last.isNotNull(), F.concat(acc["done"], F.array(last))).otherwise(acc["done"]).alias("done"),
            F.when(apart | better, s).otherwise(last).alias("last"),
        )

    # What stays ends before all that comes, whose starts are in order; only the last one can overlap.
    start = F.struct(F.array().cast(f"array<{ADDED}>").alias("done"), F.lit(None).cast(ADDED).alias("last"))
    return F.aggregate(passed, start, step, lambda acc: F.concat(acc["done"], F.filter(F.array(acc["last"]), lambda x: x.isNotNull())))


def find(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of ``start, kind (1 to 4), end`` in order."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kind = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int")
    base = F.array_sort(F.transform(
        base_spans(t), lambda s: F.struct(s["start"].alias("start"), kind(s).alias("kind"), s["end"].alias("end"))
    ))
    extra = F.transform(
        added_spans(t, model), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    )
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), base.alias("base"), extra.alias("added"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"], s["end"])), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of the rows of ``find``."""
    def count(number: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    counts = [count(n, kind) for n, kind in enumerate(KINDS, 1)]
    return found.select(
        "doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, model: Model, text: str = "text", sign: str = "*") -> DataFrame:
    """``docs`` with all characters of found spans replaced in the text; NULL stays NULL."""

    def cover(p: Column) -> Column:
        # Each piece begins where the one before ended: spans in order, overlaps cut off.
        def step(acc: Column, s: Column) -> Column:
            start, end = F.greatest(s["start"], acc["at"]), F.greatest(s["end"], acc["at"])
            kept = F.substring(p["t"], acc["at"] + 1, start - acc["at"])
            return F.struct(
                end.alias("at"), F.concat(acc["done"], F.array(F.concat(kept, F.repeat(F.lit(sign), end - start)))).alias("done")
            )

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done"))
        return F.aggregate(
            p["spans"], start, step,
            lambda acc: F.concat(F.array_join(acc["done"], ""), F.substring(p["t"], acc["at"] + 1, F.length(p["t"]))),
        )

    t = F.col(text).cast("string")
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    spans = F.array_sort(F.concat(F.transform(base_spans(t), plain), F.transform(added_spans(t, model), plain)))
    return docs.withColumn(text, F.when(t.isNotNull(), let(F.struct(t.alias("t"), spans.alias("spans")), cover)))
