"""The corpus pipeline: quality rules, near-dedup, decontamination, secret scans, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichlab.llm.bpe import encode_and_decode
from enrichlab.llm.common import read, work_dir
from enrichlab.llm.decontaminate import drop_leaks
from enrichlab.llm.minhash_dedup import keep_one_of_each
from enrichlab.llm.quality_rules import keep_quality
from enrichlab.llm.secret_scan import redact_secrets
from enrichlab.session import forget_at_exit


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the references are counted over this stage's input.  Null and empty texts go
    (they have no words); null ids and repeated rows are kept as they are."""
    return keep_quality(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least id; of repeated rows one.  Texts without words are one
    class; rows with a null id stay."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null texts and ids stay, an empty benchmark changes nothing."""
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kind; ``n_chars`` follows the text."""
    clean = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of what is kept, checked by decoding; a null text has no ids."""
    done = encode_and_decode(docs)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("dedup", dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("encode", encode),
]

#: The near-duplicate stage, the references of the quality rules and the merges are beyond SQL; the
#: tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the stages' tables lie in the shared checkpoint folder until the application ends.  An
    empty table gives an empty result."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{work_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    forget_at_exit(spark, folder)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
