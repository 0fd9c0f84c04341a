"""Picking rows: the newest version of a key, the n-th newest, the k best of a group, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def nth_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The n-th row of each key in the given order."""
    return ranked(df, keys, order, "_n").where(F.col("_n") == n).drop("_n")


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return nth_by(df, keys, order, 1)


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each key; Spark trims each task's rows to k before the shuffle."""
    return ranked(df, keys, order, name).where(F.col(name) <= k)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Newest version of each key over both tables; of equal versions the new table's row."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_by(both, keys, [F.desc_nulls_last(version), F.desc("_new")]).drop("_new")


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and of the new ones those whose key is not there yet."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def replace_range(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Every old row of a key that the new table has goes; all new rows come."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def filled_from(df: DataFrame, other: DataFrame, keys: list[str], column: str, fallback: Column) -> DataFrame:
    """df with the nulls of a column filled from the row of other with the same keys (its largest value if there are several),
    else by the fallback."""
    known = other.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.max(column).alias("_from"))
    return df.join(known, keys, "left").withColumn(column, F.coalesce(column, "_from", fallback)).drop("_from")


def with_dense_ids(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """df with ids start + 1, start + 2, ... in the order of columns that tell all rows apart. Rows are dealt out by ranges and
    stored so; the ranges' counts, a row each, are summed up, and each range numbers its own rows, so no task holds them all."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.partitionBy().orderBy("_range")) - F.col("_n")).alias("_before"))  # a row a range
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranges.withColumn("_nth", nth).join(before, "_range").withColumn(name, (F.col("_before") + F.col("_nth") + F.lit(start)).cast("long")).drop("_range", "_nth", "_before")


def continue_ids(old: DataFrame, new: DataFrame, order: list[str], name: str) -> DataFrame:
    """old, whose rows have ids, and the rows of new with the ids that follow old's highest one."""
    highest = old.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    return old.unionByName(with_dense_ids(new, order, name, highest).select(*old.columns))
