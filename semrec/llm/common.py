"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_parallelism, scratch_path, ship_package

WHITESPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``columns`` (all when none) of the whole parquet table ``name``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df.select(*columns) if columns else df)


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file (the same on every machine)."""
    import public_tokenizers  # only operators that read a vocabulary need it

    return public_tokenizers.path(name)


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def python_ready(df: DataFrame) -> DataFrame:
    """Make this package importable in Python workers, then ``df`` unchanged."""
    ship_package(df.sparkSession)
    return df


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    Used where a later step reads a result more than once, or must see the
    very same rows again after an executor is lost.  The table goes when the
    application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "frozen")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
