"""Cleaning a corpus in five stages: toxic documents go, one document of each near-duplicate group stays, documents that
hold benchmark items go, secrets are masked, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; its rows are written as Parquet in the shared folder and
read again as the next stage's ``docs``, so an executor that is lost costs at most the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.llm import bpe, decontaminate, secrets, simhash, toxicity
from docket.llm.common import stored, table
from docket.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, the model trained on the labelled ones among them.

    Null texts count as empty and are judged as such; repeated rows go or stay together; rows without an id are judged
    like others; columns of any name pass unchanged; without labelled rows every document scores 0.5 and goes.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    aside = {c: f"_own_{c}" for c in ("score", "predicted") if c in docs.columns}
    clean = toxicity.score(docs.withColumnsRenamed(aside), model).where("predicted = 0").drop("score", "predicted")
    return clean.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component.

    Of rows with one id that with the smallest hash of its text stays; rows without an id stay. Null texts count as
    empty, and empty texts are near-duplicates of each other; columns of any name pass unchanged.
    """
    kept = simhash.near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    others = F.struct(*(c for c in docs.columns if c != "doc_id"))
    chosen = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(others, F.xxhash64("text")).alias("_row"))
    return chosen.select("doc_id", "_row.*").unionByName(docs.where("doc_id is null")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; null and empty texts hold none, rows of one id go or stay together, rows
    without an id stay, and columns of any name pass unchanged."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask; n_chars follows the text (null for a null one). Rows without an id and
    repeated ones are masked like others; columns of any name pass unchanged."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text, with their number and digests; null texts have no ids, rows without an id and
    repeated ones give a row each, and columns with the names of results are replaced."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: None: neither the trained classifier nor the fingerprints can be written in SQL; a test runs a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
