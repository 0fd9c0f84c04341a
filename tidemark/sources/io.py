"""Readers and writers: partitioned and versioned Parquet, CSV logs, reports, databases, price and option-chain pages, bar, curve
and universe JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.numbers import half_step
from tidemark.functions.text import clean, market_of, parse_expiry, parse_integer, parse_number
from tidemark.operators.rows import latest_by


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "overwrite") -> None:
    """Hive-style folders; rows of a folder are brought together first, so each gets few files."""
    df.repartition(*by).write.mode(mode).option("compression", "snappy").partitionBy(*by).parquet(path)


def write_as_of(df: DataFrame, path: str, as_of: str, *by: str) -> None:
    """A further version beside those already there."""
    write_partitioned(df.withColumn("as_of", F.lit(as_of)), path, *by, "as_of", mode="append")


def read_newest_version(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """The newest version of each key's folders. The newest ones, a row for each folder of those that the driver lists anyway, are
    broadcast, and their values prune the scan: older versions' files are not read. A comparison that always holds marks them as
    selective, without which Spark does not prune."""
    df = spark.read.parquet(path)
    newest = df.groupBy(*by).agg(F.max("as_of").alias("as_of")).where(F.col("as_of").cast("string") >= "")
    return df.join(F.broadcast(newest), [*by, "as_of"], "left_semi")


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], order: list[str], buckets: int) -> None:
    """A catalog table at path with one sorted file a bucket: joins, groupings and windows on the keys need no exchange. Before a
    union of such tables is grouped by the keys set spark.sql.unionOutputPartitioning to false, or join them instead: Spark 4.1
    takes the union for bucketed too and groups its parts each alone."""
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*order).saveAsTable(name)


def latest_on_or_before(df: DataFrame, day: Column, column: str = "trade_date") -> DataFrame:
    newest = df.where(F.col(column) <= day).agg(F.max(column).alias("_d"))
    return df.join(F.broadcast(newest), df[column] == newest["_d"], "left_semi")


def overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replaces only the partitions that df holds."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Logs with a header; empty files give no rows."""
    return spark.read.csv(path, schema=schema, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss", mode="PERMISSIVE")


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int, **options) -> DataFrame:
    """A database table in ranges of a column, so that executors read it side by side."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts), **options).load()


def bars_from_json(raw: DataFrame, column: str = "body") -> DataFrame:
    """Bar arrays of one ticker a row -> one row a bar; rows without all four prices are dropped, a missing adjusted close is
    the close."""
    schema = "ticker string, timestamp array<long>, open array<double>, high array<double>, low array<double>, close array<double>, volume array<long>, adj_close array<double>"
    p = raw.select(F.from_json(column, schema).alias("j"))
    z = F.arrays_zip(*[F.col(f"j.{c}").alias(c) for c in ("timestamp", "open", "high", "low", "close", "volume", "adj_close")])
    b = p.select(F.col("j.ticker").alias("ticker"), F.inline(z))
    named = b.toDF("ticker", "timestamp", "open", "high", "low", "close", "volume", "adj_close")
    return named.dropna(subset=["open", "high", "low", "close"]).withColumns({"adj_close": F.coalesce("adj_close", "close"), "market": market_of(F.col("ticker")), "timestamp": F.timestamp_seconds("timestamp")})


def table_rows(html: Column, fits: Callable[[Column], Column]) -> Column:
    """The rows of the tables in html as arrays of their cells' texts, null where empty; only rows whose cells fit. They are chosen
    here, before they are exploded: a filter behind would be pushed below the cells and read each row once more."""
    cell = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), r"\s+", " "))
    cells = lambda row: F.transform(F.transform(F.regexp_extract_all(row, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), cell), lambda c: F.nullif(c, F.lit("")))
    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<tr[^>]*>.*?</tr>"), F.lit(0)), cells), fits)


def chain_from_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Option-chain pages -> one row per contract. A page has sections headed by an expiry text, each with table rows of call
    bid, call ask, strike, put bid, put ask; a row gives a call and a put. Numbers are written the Dutch way."""
    sections = pages.withColumn("section", F.explode(F.split(html, "<section")))
    sections = sections.where(F.col("section").contains("</"))
    sections = sections.withColumn("head", clean(F.regexp_extract("section", r"(?s)<h[1-6][^>]*>(.*?)</h[1-6]>", 1)))
    rows = sections.withColumn("c", F.explode(table_rows(F.col("section"), lambda c: F.size(c) >= 5))).withColumn("e", parse_expiry(F.col("head")))
    num = lambda i: parse_number(F.get("c", F.lit(i)))
    side = lambda kind, bid, ask: F.struct(F.lit(kind).alias("option_type"), num(bid).alias("bid"), num(ask).alias("ask"))
    keep = [c for c in pages.columns if c != html]
    out = rows.select(*keep, F.col("e.expiry_date").alias("expiry_date"), F.col("e.symbol").alias("symbol"), half_step(num(2)).alias("strike"), F.inline(F.array(side("Call", 0, 1), side("Put", 3, 4))))
    return out.where(F.col("strike").isNotNull())


def overview_from_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Totals of a page that states them as 'N (a Calls, b Puts)'."""
    from tidemark.functions.text import call_put_totals

    text = F.regexp_replace(html, "<[^>]*>", " ")
    return pages.select(*[c for c in pages.columns if c != html], call_put_totals(text).alias("t")).select("*", "t.*").drop("t")


# Positional columns of a price table, in the order of its cells.
PRICE_COLUMNS = ["name", "isin", "last", "previous", "change", "change_pct", "high", "low", "bid", "ask", "volume", "open_interest", "time"]


def price_table_from_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Table rows of thirteen cells by position -> one row each; numbers are written the Dutch way, rows of other lengths
    (headers, totals) are left out."""
    rows = pages.withColumn("_c", F.explode(table_rows(F.col(html), lambda c: F.size(c) == len(PRICE_COLUMNS))))
    text = {"name", "isin", "time"}
    whole = {"volume", "open_interest"}
    value = lambda i, n: F.get("_c", F.lit(i)) if n in text else (parse_integer if n in whole else parse_number)(F.get("_c", F.lit(i)))
    return rows.select(*[c for c in pages.columns if c != html], *[value(i, n).alias(n) for i, n in enumerate(PRICE_COLUMNS)])


def points_from_json(raw: DataFrame, column: str = "body") -> DataFrame:
    """Time series of an interest-rate service, one response a row: {"series": .., "dates": [..], "values": [..]} -> one row a
    date (series, curve_date, rate); rates come in percent, dates without a value are left out."""
    p = raw.select(F.from_json(column, "series string, dates array<string>, values array<double>").alias("j"))
    z = p.select(F.col("j.series").alias("series"), F.inline(F.arrays_zip(F.col("j.dates").alias("d"), F.col("j.values").alias("v"))))
    return z.where("v is not null").select("series", F.to_date("d").alias("curve_date"), (F.col("v") / 100).alias("rate"))


def tickers_from_json(raw: DataFrame, column: str = "body") -> DataFrame:
    """A universe file, a list of tickers or an object with them under "tickers" or as its keys -> one row a ticker."""
    text = F.trim(column)
    listed = F.from_json(text, "array<string>")
    named = F.from_json(text, "tickers array<string>")["tickers"]
    keys = F.map_keys(F.from_json(text, "map<string,string>"))
    return raw.select(F.explode(F.when(text.startswith("["), listed).otherwise(F.coalesce(named, keys))).alias("ticker"))


def facts_of_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """Rows (name, present, n_rows, n_columns, n_files) of catalog tables."""
    out = None
    for name in names:
        there = spark.catalog.tableExists(name)
        t = spark.table(name) if there else spark.range(0)
        row = t.agg(F.lit(name).alias("name"), F.lit(there).alias("present"), F.count("*").alias("n_rows"), F.lit(len(t.columns) if there else 0).alias("n_columns"), F.lit(len(t.inputFiles()) if there else 0).alias("n_files"))
        out = row if out is None else out.unionByName(row)
    return out


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A report as CSV with a header, as JSON lines or as Parquet; a table prints its first rows instead."""
    if kind == "table":
        df.show(50, truncate=False)
    elif kind == "csv":
        df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    elif kind in ("json", "parquet"):
        df.write.mode("overwrite").format(kind).save(path)
    else:
        raise ValueError(f"unknown kind of report: {kind}")


def write_jdbc(df: DataFrame, url: str, table: str, rows_at_once: int = 500, mode: str = "append", **options) -> None:
    """Into a database table, so many rows to a statement."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=str(rows_at_once), **options).save()


def rewrite_newest(spark: SparkSession, path: str, to: str, keys: list[str], version: str) -> None:
    """The newest version of each key of the Parquet table at path, written to another place in fewer, ordered files."""
    latest_by(spark.read.parquet(path), keys, [F.desc_nulls_last(version)]).sortWithinPartitions(*keys).write.mode("overwrite").parquet(to)


def empty(df_path: str, spark: SparkSession) -> None:
    """Removes a table's rows and keeps its columns."""
    spark.createDataFrame([], spark.read.parquet(df_path).schema).write.mode("overwrite").parquet(df_path)


__all__ = ["empty", "facts_of_tables", "points_from_json", "price_table_from_pages", "rewrite_newest", "tickers_from_json", "write_jdbc", "write_report", "bars_from_json", "chain_from_pages", "latest_on_or_before", "overview_from_pages", "overwrite_partitions", "parse_integer", "read_csv", "read_jdbc", "read_newest_version", "write_as_of", "write_partitioned"]
