"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Rows are documents (doc_id, text, lang, source, n_chars); further columns pass
through all stages but the last. Defined cases are those of the operators:
documents without text are neither toxic, duplicates nor contaminated, and stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import byte_bpe, decontamination, near_dedup, pii, toxicity
from sensorlake.llm.common import no_null, stored, table

SIMILAR = 80  # per cent, from which on documents are near copies


def _records(docs: DataFrame) -> DataFrame:
    """Whole rows as one column, so that no column can clash, with a key that rows of one id and text share."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), near_dedup.row_key().alias("row"))


def _without(records: DataFrame, rows: DataFrame) -> DataFrame:
    """The records whose key is not among ``rows``. Texts are dealt by their key, in the same way at every size."""
    return records.join(rows.select("row").distinct().hint("merge"), "row", "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; the model is fitted on the labels of these documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity(F.col("text"), model) < toxicity.THRESHOLD)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest id. Of equal rows one stays."""
    judged = stored(near_dedup.near_rows(docs, SIMILAR), "judged")
    rest = _without(_records(docs), judged.where("row <> first_row"))
    twice = judged.where("row = first_row AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("row").agg(
        F.count("*").alias("n")).where("n > 1").select("row")
    if not twice.isEmpty():
        rest = rest.join(twice, "row", "left_anti").unionByName(rest.join(twice, "row", "left_semi").dropDuplicates(["row"]))
    return rest.select("record.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies inside benchmark windows."""
    records = _records(docs)
    found = decontamination.contamination(
        records.select(F.col("row").alias("doc_id"), F.col("record.text").alias("text")), table(spark, sf_dir, "benchmark"))
    hit = found.where(decontamination.is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias("row"))
    return _without(records, stored(hit, "contaminated")).select("record.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in the place of personal data."""
    return pii.masked(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (binary, four little-endian bytes each) in the place of the text, which they decode to."""
    coded = byte_bpe.round_trip(docs.withColumn("text", no_null(F.col("text"))), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "lang", "source", "n_chars", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.col("text")).alias("decodes"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("byte_bpe", as_tokens),
]

# the classifier, the learnt contexts and the merges cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
