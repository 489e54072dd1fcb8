"""Corpus pipeline: documents pass STAGES in order, each stage's result written and read again.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept:

1. toxicity: documents that the model rejects go;
2. near duplicates: of each group the document of least id stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. personal data: chosen spans are replaced in ``text``, and ``n_chars`` follows;
5. BPE: the documents with their token ids.

All but the last return the columns of ``documents``, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, minhash, pii, toxicity
from tessera.llm.common import stage, table
from tessera.llm.queries import tokenizer_json


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    own = {c: f"_own_{c}" for c in docs.columns if c.lower() in ("score", "predicted")}
    kept = toxicity.score(docs.withColumnsRenamed(own), fitted).where("predicted = 0").drop("score", "predicted")
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find(docs.select(F.struct("*").alias("_doc"), F.col("text")), pii.fit(docs), redact=True)
    text = F.when(F.col("_doc.text").isNotNull(), F.col("redacted"))
    changed = {"text": text, "n_chars": F.when(F.col("redacted") != F.coalesce("_doc.text", F.lit("")), F.char_length("redacted").cast("long")).otherwise(F.col("_doc.n_chars"))}
    return found.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, tokenizer_json())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("personal_data", redact_personal_data), ("bpe", encode)]

#: Learned and fingerprint stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` after all stages, with their token ids."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
