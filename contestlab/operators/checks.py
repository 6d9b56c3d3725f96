"""Data-quality checks on stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from contestlab.operators.frames import union_all


def check_balanced(df: DataFrame, key: str) -> DataFrame:
    """One row: smallest and largest group of `key`, and whether they are equal."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.min("n").alias("smallest"), F.max("n").alias("largest")).withColumn(
        "balanced", F.col("smallest") == F.col("largest"))


def table_shape(df: DataFrame, name: str, distinct: str | None = None) -> DataFrame:
    """Row count, column count and, if asked for, the distinct values of one column."""
    seen = F.count_distinct(distinct) if distinct else F.lit(None).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), seen.alias("n_distinct")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"), "n_distinct")


def coverage(a: DataFrame, b: DataFrame, col_a: str, col_b: str) -> DataFrame:
    """Distinct values of one column in two tables, side by side in one row."""
    tagged = a.select(F.col(col_a).cast("string").alias("v"), F.lit(True).alias("in_a")).unionByName(
        b.select(F.col(col_b).cast("string").alias("v"), F.lit(False).alias("in_a")))
    per_value = tagged.groupBy("v").agg(
        F.bool_or("in_a").alias("in_a"), F.bool_or(~F.col("in_a")).alias("in_b"))
    return per_value.filter(F.col("v").isNotNull()).agg(
        F.count_if("in_a").alias("n_a"),
        F.count_if("in_b").alias("n_b"),
        F.count_if(F.col("in_a") & F.col("in_b")).alias("n_both"))


def spot_check(tables: Mapping[str, DataFrame], cond: Column) -> DataFrame:
    """Rows of one entity across tables, tagged with the table they come from."""
    return union_all(*[
        df.filter(cond).select(F.lit(name).alias("table_name"), *df.columns) for name, df in tables.items()])
