"""Raw documents to token ids: quality, near-duplicates, decontamination, personal data, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns all rows it keeps, the
first four with the columns of ``documents``. Between stages the rows are
written as Parquet in the shared folder and read again, so a lost executor
costs work of one stage only.

In every stage an empty table gives an empty one, texts of any length are taken
whole, extra columns pass through whatever their names (the last stage has its
own columns), a null id is an id like any other, and repeated rows share a fate
unless the stage removes repeats.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apexlake.llm import bpe, decontaminate, pii, quality, simhash
from apexlake.llm.common import read_table, row_key, small, unused
from apexlake.llm.queries import PII_KEY, SIMHASH, TOKENIZER, ship
from apexlake.session import write_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and are good with a probability of at least one half.

    A null or empty text has no words and goes.
    """
    packed = docs.select("text", F.struct(*[docs[c] for c in docs.columns]).alias("_document"))
    voted = write_once(quality.vote(quality.measure(packed)).drop("text"), "pipeline-votes")
    return quality.judge(voted, quality.fit(voted)).where("kept").select("_document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the smallest id, of its texts the one with the smallest hash.

    Repeated rows are one. Null and wordless texts are copies of each other.
    """
    ship(spark)
    return simhash.representatives(docs, **SIMHASH)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without contamination by the benchmark. A null text has no words and stays."""
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    name = unused(docs, "hit")
    hit = small(found.where("contaminated").select(F.col("key").alias(name)).distinct(), "contaminated")
    return docs.join(hit, row_key("doc_id", "text") == F.col(name), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by pseudonyms; ``n_chars``, where there is one, counts the new text. Null stays null."""
    changed = pii.pseudonymise(docs, PII_KEY, counts=None)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows as token ids, with a digest of what the ids decode to. A null text has no tokens."""
    ship(spark)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(TOKENIZER))
    return encoded.select(
        "doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", encoding),
]
# EM, connected components and merges are beyond SQL; tests hold each stage against plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = write_once(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
