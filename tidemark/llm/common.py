"""What the operators share: lineage cuts in the shared folder, components of a link graph, held-out splits."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


HEAVY = 5000  # nodes of so large a share of all pairs are broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: spark.checkpoint.dir, or a local one where a local session has none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
        forget_at_end(spark, spark.sparkContext.getCheckpointDir())
    return named


def forget_at_end(spark: SparkSession, path: str) -> str:
    """path, which goes when the driver ends: results are read lazily, so nothing can go before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).deleteOnExit(where)
    return path


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, which goes when the driver ends."""
    return forget_at_end(spark, f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Compute df once into the shared folder; a lost executor costs no more than a reread."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As cut(), but as Parquet: for wide rows of which later steps read some columns, and for tables that may be small, since
    Spark knows their size and broadcasts them only under its threshold."""
    spark = df.sparkSession
    path = scratch(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, mod n; a null counts as remainder null."""
    return F.crc32(col.cast("string").cast("binary")) % n


def with_least(pairs: DataFrame, rows: int) -> DataFrame:
    """Rows (u, v, m): m is the smallest v of u. Of the at most `rows` pairs a node with very many (a star) would put all of
    its own in one task, so the least of such nodes, some thousands at most, is broadcast; pairs of others are joined."""
    most = max(100, rows // HEAVY)
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    heavy = F.broadcast(least.where(F.col("n") > most).select(F.col("u").alias("h"), F.col("m").alias("hm")))  # under HEAVY rows
    light = least.where(F.col("n") <= most).select(F.col("u").alias("l"), F.col("m").alias("lm"))
    marked = pairs.join(heavy, pairs["u"] == heavy["h"], "left")
    key = F.when(F.col("h").isNull(), F.col("u")).otherwise(F.col("v"))  # pairs of stars are dealt by their other end
    return marked.join(light, key == light["l"], "left").select("u", "v", F.coalesce("hm", "lm").alias("m"))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Connected components of links (a, b): one row (id, component) per linked id, component the smallest id reachable.

    Alternates large-star and small-star steps: every node sends its larger (then its smaller) neighbours to the
    smallest one it knows, so a chain of length n closes in about log n rounds and no node gathers its component.
    Loops and repeated links count once; nulls link nothing; no links give an empty table.
    """
    pairs = edges.where("a is not null and b is not null and a <> b")
    e = cut(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first())

    last = state(e)
    for _ in range(rounds):
        if not last[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = F.least("m", "u")
        large = with_least(both, 2 * last[0]).where("v > u").select(F.col("v").alias("u"), least.alias("v")).where("u <> v").distinct()
        small = with_least(large, 2 * last[0]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p"))
        e = cut(small.select("p.u", "p.v").where("u <> v").distinct())
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
