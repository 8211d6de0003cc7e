"""The corpus pipeline: documents pass five stages, each written and reread as the next one's input.

A stage takes (spark, docs, sf_dir). All but the last return the columns of
documents. Empty inputs give empty outputs; null and empty texts are documents
without words (the first stage rejects them).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import decontaminate, langid, nearcopies, pieces, pii
from tickline.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return langid.identify(docs, langid.fit(docs)).where(~F.col("rejected")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8) the smallest id stays.

    Rows that share that id are copies too, and one of them stays. Rows without
    words stay; so do rows with a null id.
    """
    links = nearcopies.link(docs)
    kept = links.where("kept").groupBy("group", F.when(F.col("group").isNull() | F.col("id").isNull(), F.col("place"))) \
        .agg(F.min("place").alias("place")).select("place")
    numbered = docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("place"))
    return numbered.join(kept, "place", "left_semi").select("row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's contamination rule marks go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.clean(docs, found)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text gives way to the name of its kind; n_chars follows the text."""
    clean = pii.redact(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return clean.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its ids, their number, and whether they decode to the text."""
    coded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "lang", "source", F.col("ids"), F.size("ids").cast("long").alias("n_tokens"),
                        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark", benchmark),
          ("personal_data", personal_data), ("tokens", tokens)]
ORACLE_SQL = None  # SQL expresses neither the first stage nor the last


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"{k}_{name}")
    return docs
