"""Corpus pipeline: from documents to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet and read again:

1. language: documents without a recognised language go.
2. near_copies: of each group of near copies by SimHash one document stays.
3. passages: passages of 35 words that occur more than once are cut out of
   every text; documents with nothing left go.
4. secrets: secrets in the texts are replaced by a mark.
5. packing: the texts are tokenised and packed into sequences.

All but the last return the columns of documents; n_chars follows the text.
Extra columns are kept. Null and empty texts go in the first stage, and an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.llm import langid, packing, secrets, simhash, substring
from voltlake.llm.common import saved, table

#: Scores below this aren't recognised; with four languages even a guess has more.
LEAST_SCORE = 0.2


def _with_text_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with n_chars as long as its text."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast(dict(df.dtypes)["n_chars"]))
    return df.select(*[F.col(f"`{c}`") for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.learn(docs), least=LEAST_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=3, bits=2)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text_of(substring.remove_repeats(docs).where("text <> ''"), docs.columns)


def secret_marks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text_of(secrets.redact(docs, secrets.train(spark)), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("passages", passages), ("secrets", secret_marks), ("packing", pack)]

#: The stages have no SQL form (a trained classifier, a forest, a tokeniser); tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
