"""SQL from files, and views over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """Run a statement with ``:name`` markers. Spark binds the values, so they are never pasted in.

    Spark rejects a marker without a value. Names of tables go through ``IDENTIFIER(:name)``.
    """
    return spark.sql(text, args=params)


def run_sql_file(spark: SparkSession, path: str, **params) -> DataFrame:
    """As above, with the text of a file any Hadoop file system can hold."""
    text = spark.read.text(path, wholetext=True).first()
    return run_sql(spark, text["value"], **params)


def register_views(**views: DataFrame) -> None:
    """Make each DataFrame a temporary view of its name; nothing is computed."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
