"""The training-data pipeline: five stages over whole documents, each written as Parquet.

1. quality rules      documents that fail the base limits or are multivariate outliers go
2. toxicity           documents that the pattern grammar scores as toxic go
3. near duplicates    one document of each group of similar ones stays (n-gram Jaccard join
                      over five-word shingles, similarity 0.8)
4. personal data      every span found is replaced by its kind
5. packing            best-fit packing into sequences of 2048 tokens

Each stage judges what the stage before it kept.  Null texts count as empty (they
fail the base limits), repeated rows and null ids are handled as the operators'
docstrings say, and empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semrec.llm import jaccard, packing, pii, quality, toxicity
from semrec.llm.common import frozen, table, vocabulary

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers of their group."""
    return quality.kept_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar learned from the labels does not call toxic."""
    grammar = toxicity.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    whole = docs.select("text", F.struct(*docs.columns).alias("row"))
    return toxicity.toxicity_scores(whole, grammar).where("predicted = 0").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; ``n_chars`` follows the text."""
    clean = pii.redact_documents(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequence and offset."""
    return packing.pack_documents(docs, vocabulary(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Learned scores, link components and a tokenizer are outside SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
