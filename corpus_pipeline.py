"""Documents to training sequences: language, near duplicates, benchmark passages, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import decontaminate, jaccard, langid, packing, secrets
from loamline.llm.common import staged, table

#: Share of the posterior below which a document's language counts as unknown.
MIN_SCORE = 0.5


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of docs has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    return [next(x for x in (n + "_" * k for k in range(len(taken) + 1)) if x.lower() not in taken) for n in names]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose best language has less than MIN_SCORE. Null texts go."""
    model = langid.fitted(docs.select("doc_id", "text", "lang"))
    lang, score = _free(docs, "__lang", "__score")
    found = langid.predicted(docs, model, (lang, score))
    return found.where(f"`{lang}` <> 'und' and `{score}` >= {MIN_SCORE}").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate class, the first of the stored table.

    Rows go by their place in a stored table, so repeated doc_ids, repeated rows and null doc_ids are rows like others.
    """
    (row,) = _free(docs, "__row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()))
    gone = staged(jaccard.classes(rows.select(F.col(row).alias("doc_id"), "text")).where("class_id <> doc_id").select(F.col("doc_id").alias(row)))
    if gone.count() <= jaccard.BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents. A null or empty text has no words and stays; texts are read whole; repeated rows go or stay together."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark and counts the characters anew where a text changed.

    Null and empty texts stay as they are; texts are scanned whole; every row is kept, repeated ones alike.
    """
    (name,) = _free(docs, "__redacted")
    found = secrets.redacted(docs, secrets.fitted(docs.select("doc_id", "text")), name)
    changed = F.col(name) != F.col("text")
    new = {"text": F.col(name), "n_chars": F.when(changed, F.char_length(name).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens. A null or empty text is its end id alone, a long one several pieces; repeated rows are packed each."""
    return packing.packed_documents(docs)


STAGES = [("language_id", language), ("jaccard_join", near_duplicates), ("decontamination", benchmark), ("secret_scan", secret_spans), ("best_fit_packing", packed)]

#: Fitted models, sampled paths and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next; rows as packing.packed_documents gives them."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs)
    return docs
