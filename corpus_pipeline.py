"""Training-corpus pipeline: language, repeated lines, near-duplicate documents, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the columns of ``documents`` (the last one the encoded
texts). :func:`run` writes each stage's rows as Parquet and reads them again
for the next. What a null, an empty text, a repeated row or an empty table
becomes is each operator's own definition; no stage drops a row for any other
reason than the one it is there for. Line removal comes before the near
duplicates, so an exact copy (and a near copy that differs inside its lines
only) has no line left by then and goes with its last line; what near copies
keep are lines that no earlier document has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm import crf_language, decontaminate, line_dedup, merge_dropout, ngram_join
from ridemart.llm.frames import materialize, table, with_key

#: A trained random field and seeded token ids have no SQL counterpart; tests hold the stages against plain Python.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and longer texts of which no language holds half (operator 2)."""
    model = crf_language.train(docs, keep=~crf_language.held_out())
    rest = [c for c in docs.columns if c != "text"]
    # the other columns travel as one struct: none of their names can clash with what the operator adds
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), "text")
    kept = crf_language.annotate(rows, model).where(crf_language.accepted())
    return kept.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that match an earlier line (operator 1).

    A document that had words and keeps none repeats earlier documents line by
    line: it is a copy and goes as a whole. Documents without a word stay.
    """
    rows = line_dedup.dedup_rows(docs).where(~F.col("lines.emptied")).select("row")
    if "n_chars" in docs.columns:
        chars = F.length(F.col("row").getField("text")).cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("row", F.col("row").withField("n_chars", chars))
    return rows.select("row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (operator 6)."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages (operator 5)."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = found.where(decontaminate.contaminated()).select("id", "th").distinct()
    return with_key(docs).join(bad, ["id", "th"], "left_anti").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with merge-dropout, and whether they decode to the text (operator 10)."""
    decoded = merge_dropout.round_trip(docs)
    return decoded.select("doc_id", "text", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                          F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [
    ("language", keep_known_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
