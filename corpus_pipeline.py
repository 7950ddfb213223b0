"""The corpus pipeline: toxicity, near-duplicates, repeated strings, mixture, token ids.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
returns a DataFrame; all but the last return the columns of documents. ``run`` writes
each stage's result to the shared folder and reads it again.

1. toxicity: documents scored 0.7 or higher go. Labels are read from ``sf_dir``.
2. simhash: of each group of near-duplicates (five-word shingles, similarity of 0.8
   or more) the document of the least id stays.
3. suffix_dedup: strings of 200 bytes that start more than once are cut out of the texts.
4. mixing: documents are drawn, up to 3 times, until each source has its target words, and
   come in the order of their output shards; documents without words are never drawn.
5. bpe: doc_id, n_tokens and the packed token ids of each drawn document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, mixing, simhash, suffix_dedup, toxicity
from corpusmill.plans.lineage import cut

#: SQL can't express a trained classifier or fingerprints; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_scores(docs, model, name="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.strip_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, split_last=False, name="__mix")
    drawn = mixed.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.explode("__mix.draws").alias("draw"))
    return drawn.repartition("draw.shard").sortWithinPartitions("draw.shard", "draw.place").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", strip_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
