"""Structured Streaming over ticks: hourly bars, deduplicated snapshots, upserts, session summaries, signals joined with the bars
that follow them, and trades that bars close."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import sketches
from tidemark.operators.rows import upsert


def read(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream, so many files to a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def hourly_bars(ticks: DataFrame, key: str, at: str, price: str, late: str = "2 hours", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Open, high, low, close and count of each key's windows; a tick later than `late` is dropped."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    out = ticks.withWatermark(at, late).groupBy(window, key).agg(F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.count("*").alias("ticks"))
    return out.select(key, F.col("window.start").alias("ts"), "open", "high", "low", "close", "ticks")


def sessions(ticks: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    out = ticks.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("ticks"), F.min(at).alias("first"), F.max(at).alias("last"))
    return out.drop("session_window")


def first_snapshots(quotes: DataFrame, keys: list[str], at: str, late: str = "1 day") -> DataFrame:
    """The first scrape of each key within the watermark; later ones are dropped."""
    return quotes.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def keep_newest(path: str, keys: list[str], version: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges each batch into the table at path, the newest version of a key winning. Keys lie in buckets; a
    batch reads and writes those that it touches alone, each as a further epoch beside the old one, so a repeated batch writes
    the same again and nothing is written over that is being read. read_merged() gives the table."""

    def merge(batch: DataFrame, epoch: int) -> None:
        batch = batch.withColumn("bucket", F.pmod(F.hash(*keys), F.lit(buckets)))
        touched = [r[0] for r in batch.select("bucket").distinct().collect()]  # at most `buckets` numbers
        old = batch.limit(0) if not epoch else _newest(batch.sparkSession, path, epoch).where(F.col("bucket").isin(touched)).drop("epoch")
        rows = upsert(old, batch, keys, version).withColumn("epoch", F.lit(epoch))
        rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "epoch").parquet(path)

    return merge


def _newest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    rows = rows if before is None else rows.where(F.col("epoch") < before)
    newest = rows.groupBy("bucket").agg(F.max("epoch").alias("epoch"))
    return rows.join(newest, ["bucket", "epoch"], "left_semi")


def prune_epochs(spark: SparkSession, path: str) -> int:
    """Removes the folders of epochs that a newer one of their bucket has replaced, and gives their number. To be called while no
    query reads the table or merges into it; a bucket's newest epoch always stays. A folder that is gone already counts for nothing, so a
    second run is harmless."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    value = lambda status: int(status.getPath().getName().split("=")[1])
    gone = 0
    for bucket in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/bucket=*")) or []:  # folders, as many as buckets
        epochs = sorted(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{bucket.getPath()}/epoch=*")), key=value)
        for old in epochs[:-1]:
            gone += bool(fs.delete(old.getPath(), True))
    return gone


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The table that keep_newest() keeps."""
    return _newest(spark, path).drop("bucket", "epoch")


def keep_states(path: str, keys: list[str], sums: list[str], distinct: list[str] = (), ranked: list[str] = ()) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch's counts, sums and sketches per key as one epoch of states, so a summary is kept up with every
    delivery and no row is read again. read_states() merges them."""

    def add(batch: DataFrame, epoch: int) -> None:
        part = sketches.states(batch, keys, sums, distinct, ranked).withColumn("epoch", F.lit(epoch))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)

    return add


def read_states(spark: SparkSession, path: str, keys: list[str], sums: list[str], distinct: list[str] = (), ranked: list[str] = ()) -> DataFrame:
    return sketches.figures(sketches.merged(spark.read.parquet(path), keys, sums, distinct, ranked), distinct, ranked)


def signals_with_bars(signals: DataFrame, bars_: DataFrame, reach: str = "20 hours", late: str = "2 hours", late_bars: str | None = None) -> DataFrame:
    """Each signal (ticker, t_end, trade_id, ...) with the bars (ticker, ts, ...) of its ticker that follow it within `reach`; both
    may be streams. A signal without any such bar comes once with null bar columns, as soon as none can come any more: the
    watermark, the lesser of the two, has passed its reach, and until then a late bar still finds it. The bounds on both sides let
    the state of either go; rows later than the watermark are dropped. The bar's columns but ts get
    the prefix bar_."""
    left = signals.withWatermark("t_end", late)
    right = bars_.withColumnsRenamed({c: f"bar_{c}" for c in bars_.columns if c != "ts"}).withWatermark("ts", late_bars or late)
    near = F.expr(f"ticker = bar_ticker AND ts > t_end AND ts <= t_end + INTERVAL {reach}")
    return left.join(right, near, "left_outer").drop("bar_ticker")


def first_hits(joined: DataFrame, width: str = "1 hour") -> DataFrame:
    """Of a stream of signals_with_bars, per signal and window of bar time: how many bars came, their extremes and first and last
    close. The watermark of the join carries on to this aggregation, so a window comes once, when it is whole."""
    hit = joined.where("ts is not null").groupBy(F.window("ts", width), "ticker", "trade_id").agg(F.count("*").alias("bars"), F.max("bar_high").alias("highest"), F.min("bar_low").alias("lowest"), F.min_by("bar_close", "ts").alias("first_close"), F.max_by("bar_close", "ts").alias("last_close"))
    return hit.select("ticker", "trade_id", F.col("window.start").alias("from_ts"), "bars", "highest", "lowest", "first_close", "last_close")


CLOSED = "ticker string, trade_id string, entry_ts timestamp, exit_ts timestamp, exit_type string, exit_price double, bars_held int"
_OPEN = "entry_us long, d int, target double, stop double, bars int, last double, bar_us long"


def closed_trades(events: DataFrame, hold: int = 20, late: str = "2 hours", longest: str = "30 days", shards: int = 1) -> DataFrame:
    """Trades that new bars close, out of a stream of signals and bars (ticker, ts, kind, trade_id, side, target, stop, high, low,
    close): kind "signal" opens one, each later "bar" of the ticker may reach its target (looked at first) or stop, or be the
    last of `hold` bars. A trade still open when event time is `longest` past its entry closes as EXPIRED at its last bar's close.

    Bars wait in the state until the watermark has passed them and are then applied in order of time, so the trades are the same
    in whatever order the rows come; rows later than `late` are dropped. A bar that comes again counts once, with the values of the
    greatest (high, low, close); a trade id that comes again opens nothing while it is open or waits. Signals without side, target
    or stop and bars without their three prices are left out, as are rows without a ticker or a time. Each trade and each waiting
    bar is one entry of a map state, so a change writes that entry alone. A ticker with very many trades is dealt to `shards` by
    trade id, its bars copied to each. The session must keep its state in RocksDB (build_session sets that)."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    limit = int(pd.Timedelta(longest).total_seconds() * 1_000_000)
    names = [c.split(" ")[0] for c in CLOSED.split(", ")]

    class Trades(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.open = handle.getMapState("open", "trade_id string", _OPEN)
            self.waiting = handle.getMapState("waiting", "us long", "high double, low double, close double")
            self.through = handle.getValueState("through", "ms long")

        def handleInputRows(self, key, rows, timerValues):
            due = []
            for part in rows:
                for r in part.itertuples(index=False):
                    us = r.ts.value // 1000
                    if r.kind == "signal":
                        if not self.open.containsKey((r.trade_id,)):
                            self.open.updateValue((r.trade_id,), (us, 1 if r.side == "LONG" else -1, r.target, r.stop, 0, None, None))
                            due.append(-(-(us + limit) // 1000))
                    else:
                        new, old = (r.high, r.low, r.close), self.waiting.getValue((us,))
                        if old is None or tuple(old) < new:
                            self.waiting.updateValue((us,), new)
                        due.append(-(-us // 1000))
            if due:
                self.handle.registerTimer(min(due))
            yield pd.DataFrame(columns=names)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            """One pass over all that the watermark has passed, whichever timer comes first; then the next timer of the key."""
            now = timerValues.getCurrentWatermarkInMs()
            out = []
            if not (self.through.exists() and self.through.get()[0] >= now):
                self.through.update((now,))
                waiting = {k[0]: tuple(v) for k, v in self.waiting.iterator()}
                ready = sorted(us for us in waiting if us <= now * 1000)
                trades = {k[0]: tuple(v) for k, v in self.open.iterator()}
                for trade_id, (entry, d, target, stop, n, last, at) in trades.items():
                    done, was = None, n
                    for us in ready:
                        if us <= entry:
                            continue
                        if us > entry + limit:
                            break
                        high, low, close = waiting[us]
                        best, worst = (high, low) if d > 0 else (low, high)
                        n, last, at = n + 1, close, us
                        if d * (best - target) >= 0:
                            done = "TARGET", target
                        elif d * (worst - stop) <= 0:
                            done = "STOP", stop
                        elif n >= hold:
                            done = "TIME", close
                        if done:
                            break
                    if not done and entry + limit <= now * 1000:
                        done, at = ("EXPIRED", last), entry + limit
                    if done:
                        self.open.removeKey((trade_id,))
                        out.append((key[0], trade_id, pd.Timestamp(entry, unit="us"), pd.Timestamp(at, unit="us"), *done, n))
                    elif n > was:
                        self.open.updateValue((trade_id,), (entry, d, target, stop, n, last, at))
                    if done:
                        trades[trade_id] = None
                for us in ready:
                    self.waiting.removeKey((us,))
                left = [-(-us // 1000) for us in waiting if us > now * 1000] + [-(-(t[0] + limit) // 1000) for t in trades.values() if t]
                if left:
                    self.handle.registerTimer(min(left))
            yield pd.DataFrame(out, columns=names)

        def close(self):
            pass

    is_signal = F.col("kind") == "signal"
    whole = F.when(is_signal, F.col("trade_id").isNotNull() & F.col("side").isNotNull() & F.col("target").isNotNull() & F.col("stop").isNotNull()).otherwise((F.col("kind") == "bar") & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull())
    rows = events.where(whole & F.col("ticker").isNotNull() & F.col("ts").isNotNull()).select("ticker", "ts", "kind", "trade_id", "side", *(F.col(c).cast("double").alias(c) for c in ("target", "stop", "high", "low", "close"))).withWatermark("ts", late)
    every = F.array(*[F.lit(i) for i in range(shards)])
    dealt = rows.withColumn("shard", F.explode(F.when(is_signal, F.array(F.pmod(F.hash("trade_id"), F.lit(shards)))).otherwise(every)))
    return dealt.groupBy("ticker", "shard").transformWithStateInPandas(Trades(), CLOSED, "append", "eventTime")


def run_available(df: DataFrame, checkpoint: str, sink: Callable | None = None, name: str = "bars", mode: str = "append"):
    """Works off all there is and stops; the checkpoint remembers how far it came."""
    w = df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).outputMode(mode)
    q = (w.foreachBatch(sink) if sink else w.format("memory").queryName(name)).start()
    q.awaitTermination()
    return q
