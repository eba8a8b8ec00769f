"""A corpus pipeline of four of the operators, each stage written as Parquet and read again.

Quality classifier -> n-gram Jaccard join (five words, similarity 0.8) ->
mixing of sources -> sampled SentencePiece encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm import mixing, ngram_join, piece_lattice, quality_cnn
from statuta.llm.common import stored
from statuta.llm.token_counts import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like any other text; repeated rows and
    null ids are rows of their own, and equal texts share their fate. An empty
    table stays empty, and without labels nothing is rejected. All columns
    are returned as they came.
    """
    model = quality_cnn.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    whole = docs.select("text", F.struct("*").alias("_whole"))
    return quality_cnn.classify(whole, model).where("_predicted = 1").select("_whole.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest id's, null ids last.

    Groups are components of texts with a Jaccard similarity of 0.8 or more
    in five-word shingles; shorter texts are one shingle. Texts that are null,
    empty or white space are in no group and stay, repeated or not. Of rows
    equal in every column one stays. An empty table stays empty.
    """
    return ngram_join.keep_one(docs, 5, 80, 100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, three times at most.

    A null source is a source of its own. Documents without words count 0
    words and are taken as often as their place says. Rows equal in id, source
    and text share a place, and as many of them are taken as the target asks
    for. An empty table stays empty.
    """
    return mixing.repeat(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of the whole texts.

    Null and empty texts have no pieces. The draw is seeded by doc_id (null: 0)
    and place, so rows of equal id and text, as the mix repeats them, have
    equal segmentations. An empty table gives no rows.
    """
    out = piece_lattice.encode(docs.select("doc_id", "source", "text"), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", "source", F.col("_n_pieces").cast("long").alias("n_pieces"), F.col("_ids").alias("ids"), F.col("_lossless").alias("lossless"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mixture", mixture), ("pieces", pieces)]

#: SQL can't express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
