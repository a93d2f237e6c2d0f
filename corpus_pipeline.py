"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import linededup, ngramjoin, packing, pii, queries, toxicity
from pulsegrid.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return toxicity.scored(docs.select(*COLUMNS), model).filter(F.col("score") < queries.TOXIC).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that their source puts on its documents."""
    out = linededup.drop_site_lines(docs.select(*COLUMNS), "doc_id", "text", F.col("source"),
                                    ratio=queries.LINE_RATIO, min_pages=queries.LINE_PAGES)
    return _documents(out)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id:
    word shingles of five, similarity of 0.8 or more."""
    found = ngramjoin.joined(docs, k=5, percent=80).select(F.col("doc_id").alias("id"), "component_id")
    gone = found.filter(F.col("id") > F.col("component_id")).select("id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["id"], "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return _documents(pii.personal_data(docs.select(*COLUMNS), mask=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 4096 tokens."""
    return packing.packed(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_boilerplate), ("ngram_jaccard", drop_near_copies),
          ("pii", mask_personal_data), ("packing", pack)]

#: The string kernel, the n-gram components and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
