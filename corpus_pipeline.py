"""A corpus pipeline of five of the operators in ``sparkloom.llm``, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's documents; all but the last keep the
columns of documents. Toxicity and decontamination drop what they reject, the
join keeps one document of each class of near copies, the secret scan masks live
credentials in the text, the last stage returns token figures per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import bpe, decontaminate, ngram_join, secrets, toxicity
from sparkloom.llm.common import table
from sparkloom.llm.queries import documents, tokenizer_path
from sparkloom.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labelled rows of the whole table, whatever is left of it in ``docs``."""
    model = toxicity.fit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_live(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.roundtrip(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_copies),
          ("benchmark_decontamination", drop_benchmark), ("secret_scan", mask_secrets), ("bpe", tokenize)]

#: A trained model decides in the first stage, so the rows are checked stage by stage in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
