"""From raw documents to a training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.llm import decontaminate, language, line_dedup, mixing, near_copies, simhash
from acctlake.llm.common import scratch_scope, stage, table, with_row
from acctlake.llm.components import components

#: No SQL: the stages hold trained models and iterations. Tests compare run() with a plain version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose letters no mixture of languages explains better than chance, are
    rejected. Learned from all documents that carry a language; the column ``lang`` stays as it is."""
    model = language.train(docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    kept = language.predict(docs.toDF(*names), model, names, text=names[docs.columns.index("text")])
    return kept.where(language.accepted()).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines are deleted; documents of which no word is left go. ``n_chars`` is counted anew."""
    cleaned = line_dedup.dedup_lines(docs)
    emptied = (F.size("lines_deleted") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cleaned = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        shorter = F.size("lines_deleted") > 0
        cleaned = cleaned.withColumn("n_chars", F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest doc_id, NULL last; of several rows with this doc_id
    the first in the files. Linked are documents whose SimHash fingerprints (as in ``op6``: three-word shingles) differ in two bits at most,
    and those whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    numbered = with_row(docs, "row__near")
    with scratch_scope(spark):
        groups = stage(near_copies.near_copies(numbered, carried=("row__near",)), "groups")
        prints = simhash.near_duplicates(numbered, carried=("row__near",))
        groups = _merged(groups, stage(prints.select("row__near", F.col("component").alias("print")), "prints"))
        candidate = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row__near")
        firsts = groups.groupBy("component").agg(F.min(candidate).alias("first"), F.count("*").alias("n")).where("n > 1")
        # Both tables are written before they are joined: sizes are known, and a large group is a key that can be split.
        firsts = stage(firsts.select("component", F.col("first.row__near").alias("stays")), "firsts")
        gone = groups.join(firsts, "component").where(F.col("row__near") != F.col("stays"))
        gone = stage(gone.select(F.col("row__near.file").alias("file__gone"), F.col("row__near.at").alias("at__gone")), "gone", keep=True)
    here = (F.col("row__near.file") == F.col("file__gone")) & (F.col("row__near.at") == F.col("at__gone"))
    return numbered.join(gone, here, "left_anti").select(*docs.columns)


def _merged(groups: DataFrame, prints: DataFrame) -> DataFrame:
    """``groups`` with one ``component`` for all that share a ``print``."""
    # Most prints belong to one document, and most others to one group.
    several = stage(prints.groupBy("print").count().where("count > 1").select("print"), "several")
    found = prints.join(several, "print").join(groups.select("row__near", "component"), "row__near")
    met = stage(found.select("print", "component").distinct(), "met")
    least = met.groupBy("print").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    least = stage(least.drop("most"), "least")
    if least.isEmpty():
        return groups
    apart = met.join(least, "print").where("component <> least")
    roots = stage(components(apart.select(F.col("component").alias("a"), F.col("least").alias("b"))), "roots")
    joined = groups.join(roots.withColumnRenamed("node", "component"), "component", "left")
    return stage(joined.withColumn("component", F.coalesce("root", "component")).drop("root"), "merged")


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``size`` in words and ``taken`` (words, repeats counted)."""
    numbered = with_row(docs, "row__mix")
    with scratch_scope(spark):
        mixed = mixing.mix(numbered, carried=("row__mix",)).where("taken > 0").select(
            F.col("carried.row__mix.file").alias("file__taken"), F.col("carried.row__mix.at").alias("at__taken"),
            *[F.col(c).alias(f"{c}__mix") for c in MIXED],
        )
        mixed = stage(mixed, "mixed", keep=True)
    here = (F.col("row__mix.file") == F.col("file__taken")) & (F.col("row__mix.at") == F.col("at__taken"))
    return numbered.drop(*MIXED).join(mixed, here).select(
        *[c for c in docs.columns if c not in MIXED], *[F.col(f"{c}__mix").alias(c) for c in MIXED]
    )


#: Columns that the mix adds; they replace columns of these names.
MIXED = ("size", "source_size", "target", "taken")

STAGES = [
    ("language", identify_language),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("decontamination", remove_benchmarks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is a written table in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
