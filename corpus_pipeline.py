"""Corpus pipeline: the STAGES applied in order to ``documents``.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import langid
from telemetra.llm.common import stage, stored, without
from telemetra.llm.exact_dedup import exact_dedup
from telemetra.llm.jaccard_join import row_components
from telemetra.llm.mixing import mixed_documents
from telemetra.llm.queries import tokenizer

#: Documents whose language is less certain than this go, as do those without a letter.
LEAST_SCORE = 0.3


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without letters or of uncertain language go."""
    rows = langid.predict_rows(docs, langid.fit(docs))
    return rows.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space aside) stays.

    Rows are told apart by a number that is written with them: a second scan
    may split the files of ``docs`` in another way and so number it otherwise.
    """
    numbered = stored(docs.withColumn("place in table", F.monotonically_increasing_id()), "pipeline-numbered")
    verdicts = exact_dedup(numbered, carry="place in table")
    gone = stored(verdicts.filter("not kept").select(F.col("carried").alias("id")), "pipeline-copies")
    return without(numbered, "place in table", gone).drop("place in table")


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that are linked by similar shingle sets the smallest id stays, a null id being last.

    Every row is a document of its own, whatever its id.
    """
    numbered = stored(docs.withColumn("place in table", F.monotonically_increasing_id()), "pipeline-numbered")
    linked = row_components(numbered, "place in table")
    stays = linked.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("a"), "id", "row")).alias("m"))
    gone = stored(linked.join(stays.select("m.row"), "row", "left_anti").select(F.col("row").alias("id")),
                  "pipeline-near")
    return without(numbered, "place in table", gone).drop("place in table")


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixed_documents(docs)


@stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of their decoding.

    The ids are written before they are decoded: in one plan, a task holds a
    worker for each of the two at a time.
    """
    codec = tokenizer(spark)
    return codec.decode(stored(codec.encode(docs), "pipeline-ids")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]

#: The language model and the draws of the mix are no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stored(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
