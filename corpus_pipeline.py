"""The corpus pipeline: from raw documents to piece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller, or
``run`` below, writes it as Parquet and gives it to the next stage. All stages but
the last return the columns of ``documents``, and each works on everything
that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm.common import settled
from martweave.llm.line_dedup import dedup_lines
from martweave.llm.mixing import mix, topic_of
from martweave.llm.ngram_join import group_similar
from martweave.llm.pieces import encode
from martweave.llm.quality import score_texts, train
from martweave.llm.queries import MIX_SEED, PIECE_MODEL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORDS, PERCENT = 5, 80
# Shares of tokens, near those of a cleaned crawl: mixing corrects it and keeps most of it.
TARGETS = {
    "source": {"src1": 0.036, "src2": 0.036, "src3": 0.036, "src4": 0.036},
    "lang": {"de": 0.14, "fr": 0.13, "es": 0.11},
    "topic": {"short": 0.012},
}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (a score of at least one half)."""
    scorer, _ = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_texts(docs.select(COLUMNS), scorer, "__score").where("__score >= 0.5").select(COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that several share; those with nothing but such lines go."""
    done = dedup_lines(docs.select(COLUMNS))
    done = done.where((F.length("text") > 0) | (F.col("n_dropped") == 0))
    return done.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    grouped, rows, unique = group_similar(docs, WORDS, PERCENT)
    first = grouped.where("id = component").select("id").distinct()
    if unique:
        return docs.join(first, F.col("doc_id") == F.col("id"), "left_semi").select(COLUMNS)
    # Ids are null or repeated: rows are told apart by their texts, and equal rows are one.
    texts = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), *COLUMNS[1:])
    kept = rows.join(first, "id", "left_semi").select(
        F.col("doc_id").alias("kept_id"), F.sha2("raw", 256).alias("kept_digest")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    return texts.join(kept, same, "left_semi").dropDuplicates(["doc_id", "digest"]).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled towards target shares of source, language and topic."""
    docs = docs.select(COLUMNS).withColumn("topic", topic_of(F.col("text")))
    return mix(docs, TARGETS, seed=MIX_SEED).select(COLUMNS)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document."""
    coded = encode(docs.select("doc_id", "lang", "source", "text"), PIECE_MODEL, without=["text"])
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_ids"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("mixing to target weights", mix_sources),
    ("SentencePiece encoding", to_pieces),
]
# The classifier and the encoding are beyond SQL; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
