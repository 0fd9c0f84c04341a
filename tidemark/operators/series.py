"""Ordered series per key: gated rolling windows, islands, ordered folds, as-of lookups, first hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import WindowSpec


def series(key: str, order: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def rolling(agg: Callable[[Column], Column], col: Column, over: WindowSpec, n: int, least: int | None = None) -> Column:
    """Aggregate of the last n rows, null until `least` of them (all n by default) hold a value."""
    frame = over.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) >= (n if least is None else least), agg(col).over(frame))


def islands(df: DataFrame, key: str, order: str, flag: Column, name: str = "island") -> DataFrame:
    """Number of the run of flagged rows that a row belongs to; null outside runs."""
    w = series(key, order)
    start = (flag & ~F.coalesce(F.lag(flag).over(w), F.lit(False))).cast("int")
    return df.withColumn(name, F.when(flag, F.sum(start).over(w.rowsBetween(Window.unboundedPreceding, 0))))


def run_length(df: DataFrame, key: str, order: str, by: list[str], name: str = "run_length") -> DataFrame:
    """How many rows in a row, up to this one, have had the same values in `by`."""
    w = series(key, order)
    change = F.coalesce(F.struct(*by) != F.lag(F.struct(*by)).over(w), F.lit(True)).cast("int")
    return df.withColumn("_run", F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(name, F.row_number().over(Window.partitionBy(key, "_run").orderBy(order))).drop("_run")


def streamed(df: DataFrame, key: str, order: str, added: str, work: Callable[[dict, pa.RecordBatch], list]) -> DataFrame:
    """df with further columns (a DDL text) out of each key's rows in order: work(state, rows) gives their values for some rows
    of one key, state being a dict that lasts over the key's rows. Rows stream past, so no series is ever held whole."""
    names = df.columns
    at = names.index(key)
    schema = StructType([*df.schema.fields, *(StructField(f.name, f.dataType) for f in StructType.fromDDL(added).fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, {}
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(at).dictionary_encode()
            codes, known = keys.indices.to_numpy(zero_copy_only=False), keys.dictionary.to_pylist()
            starts = [0, *(np.nonzero(codes[1:] != codes[:-1])[0] + 1).tolist(), b.num_rows]
            for first, end in zip(starts, starts[1:]):
                mine = b.slice(first, end - first)
                value = None if np.isnan(codes[first]) else known[int(codes[first])]
                if not state or value != now:
                    now, state = value, {"key": value}
                yield pa.RecordBatch.from_arrays([*mine.columns, *work(state, mine)], names=schema.names)

    return df.repartition(key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def ewm(df: DataFrame, key: str, order: str, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Recursive exponential means: columns maps a name to (source, span); a source may be another one's name or the difference
    of two, "a - b". A mean starts at the first value that is not null and is null until `span` values have come."""
    names = df.columns

    def work(state: dict, rows: pa.RecordBatch) -> list:
        have: dict[str, list] = {}

        def values(source: str) -> list:
            if " - " in source:
                left, right = (values(x) for x in source.split(" - "))
                return [None if x is None or y is None else x - y for x, y in zip(left, right)]
            if source not in have:
                have[source] = rows.column(names.index(source)).to_pylist()
            return have[source]

        for name, (source, span) in columns.items():
            a = 2.0 / (span + 1)
            last, n = state.get(name, (None, 0))
            out = []
            for x in values(source):
                if x is not None:
                    last, n = (x if last is None else a * x + (1 - a) * last), n + 1
                out.append(last if n >= span else None)
            state[name], have[name] = (last, n), out
        return [pa.array(have[name], pa.float64()) for name in columns]

    return streamed(df, key, order, ", ".join(f"`{name}` double" for name in columns), work)


def next_and_previous(facts: DataFrame, events: DataFrame, key: str, day: str, event_day: str, prefix: str, value: str | None = None) -> DataFrame:
    """For each fact the next event on or after its day and the last one before it, by one union and two running windows, one
    of them backwards, in place of a range join. Adds <prefix>_next and <prefix>_prev, and <prefix>_value of the next one."""
    extra = [F.col(value).alias("_v")] if value else [F.lit(None).cast("double").alias("_v")]
    marks = events.select(key, F.col(event_day).alias("_d"), *extra).groupBy(key, "_d").agg(F.max("_v").alias("_v"))
    both = facts.withColumn("_d", F.col(day)).withColumn("_e", F.lit(0)).unionByName(marks.withColumn("_e", F.lit(1)), allowMissingColumns=True)
    backwards = Window.partitionBy(key).orderBy(F.desc("_d"), F.desc("_e")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy(F.col("_d"), F.col("_e")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    event = F.when(F.col("_e") == 1, F.struct(F.col("_d").alias("d"), F.col("_v").alias("v")))
    seen = both.withColumn("_nx", F.last(event, ignorenulls=True).over(backwards)).withColumn("_pv", F.max(F.when(F.col("_e") == 1, F.col("_d"))).over(before))
    out = seen.where("_e = 0").withColumn(f"{prefix}_next", F.col("_nx.d")).withColumn(f"{prefix}_prev", F.col("_pv"))
    if value:
        out = out.withColumn(f"{prefix}_value", F.col("_nx.v"))
    return out.drop("_d", "_e", "_v", "_nx", "_pv")


def numbered(df: DataFrame, key: str, order: str, name: str = "idx") -> DataFrame:
    """Position of each row in its key's series, from 1 on."""
    return df.withColumn(name, F.row_number().over(series(key, order)).cast("long"))


def forward(events: DataFrame, bars: DataFrame, key: str, at: str, n: int, columns: list[str], start: int = 1, idx: str = "idx") -> DataFrame:
    """The next n bars after position `at` of each event: an equi join on key and position, each event's positions spelled
    out, so that no range condition is left to the join. Adds `step` (start .. n) and the bars' columns as f_<name>."""
    spread = events.withColumn("step", F.explode(F.sequence(F.lit(start), F.lit(n)))).withColumn("_at", F.col(at) + F.col("step"))
    b = bars.select(F.col(key).alias("_k"), F.col(idx).alias("_i"), *[F.col(c).alias(f"f_{c}") for c in columns])
    return spread.join(b, (spread[key] == b["_k"]) & (spread["_at"] == b["_i"])).drop("_k", "_i", "_at")
