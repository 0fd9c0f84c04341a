"""Series cut by position: what would be one task for a key's whole series is done in spans of a bounded number of rows.

A row's position is counted by period first (rows of a key and period in one task, periods summed up by key), so no step gathers
a key. Spans are runs of `length` positions. Look-backs of a fixed number of rows get a halo: each span also receives copies of
the rows before it. Unbounded recursions are scans: every span works out its own part and what it does to a value that comes
in; the spans' summaries, one row each, are folded by key; the value that comes in is then applied to the span's rows."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.operators.series import streamed

LENGTH = 1024
POWER = 600.0  # exponents of e up to this stay in a double's range, both ways


def positioned(df: DataFrame, key: str, order: str, period: Column, name: str = "pos") -> DataFrame:
    """Position of each row in its key's series, from 1 on. `period` must not fall as `order` rises; a task sorts the rows of one
    key and period. Periods are few, so their counts are summed up by key."""
    counts = df.groupBy(key, period.alias("_period")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col(key).alias("_k"), F.col("_period").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"))
    own = df.withColumn("_period", period).withColumn("_nth", F.row_number().over(Window.partitionBy(key, "_period").orderBy(order)))
    met = own.join(starts, F.col(key).eqNullSafe(F.col("_k")) & F.col("_period").eqNullSafe(F.col("_p")))
    return met.withColumn(name, (F.col("_before") + F.col("_nth")).cast("long")).drop("_period", "_nth", "_k", "_p", "_before")


def span_of(pos: str, length: int) -> Column:
    return F.floor((F.col(pos) - 1) / length).cast("long")


def with_halo(df: DataFrame, pos: str, before: int, length: int = LENGTH) -> DataFrame:
    """Every row in its span and, as a copy, in those spans that start at most `before` positions after it. Adds `span` and `own`."""
    last = F.floor((F.col(pos) - 1 + before) / length).cast("long")
    spread = df.withColumn("span", F.explode(F.sequence(span_of(pos, length), last)))
    return spread.withColumn("own", F.col("span") == span_of(pos, length))


def in_span(key: str, pos: str) -> WindowSpec:
    return Window.partitionBy(key, "span").orderBy(pos)


def _carried(df: DataFrame, key: str, summary: dict[str, Column], fold: dict[str, Column]) -> DataFrame:
    """df with what comes into each span: summary are aggregates of a span, fold expressions over the spans before."""
    each = df.groupBy(key, "span").agg(*[c.alias(n) for n, c in summary.items()])
    spans = each.select(F.col(key).alias("_k"), F.col("span").alias("_s"), *[c.alias(n) for n, c in fold.items()])
    return df.join(spans, F.col(key).eqNullSafe(F.col("_k")) & (F.col("span") == F.col("_s")), "left").drop("_k", "_s")


def earlier(key: str) -> WindowSpec:
    """Over span summaries: all spans of the key before this one."""
    return Window.partitionBy(key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)


def running_sums(df: DataFrame, key: str, pos: str, sums: dict[str, Column]) -> DataFrame:
    """Cumulative sums over each key's series: name -> values, summed up within spans and carried from span to span."""
    up = in_span(key, pos).rowsBetween(Window.unboundedPreceding, 0)
    fold = {f"_in_{n}": F.coalesce(F.sum(f"_all_{n}").over(earlier(key)), F.lit(0)) for n in sums}
    met = _carried(df, key, {f"_all_{n}": F.sum(c) for n, c in sums.items()}, fold)
    out = met.withColumns({n: F.coalesce(F.sum(c).over(up), F.lit(0)) + F.col(f"_in_{n}") for n, c in sums.items()})
    return out.drop(*fold)


def run_lengths(df: DataFrame, key: str, pos: str, by: list[str], name: str = "run_length") -> DataFrame:
    """How many rows in a row, up to this one, have had the same values in `by`. A run goes on over a span's end if the next one
    starts as the last one ended; its start is the newest change at or before it."""
    w = in_span(key, pos)
    now = F.struct(*by)
    start = F.when(~now.eqNullSafe(F.lag(now).over(w)), F.col(pos))  # a span's first row counts as a change until it is looked at
    marked = df.withColumns({"_first": F.row_number().over(w) == 1, "_start": start})
    summary = {"_head": F.min_by(now, F.col(pos)), "_tail": F.max_by(now, F.col(pos)), "_from": F.min(pos), "_last": F.max(F.when(~F.col("_first"), F.col("_start")))}
    each = marked.groupBy(key, "span").agg(*[c.alias(n) for n, c in summary.items()])
    goes_on = F.col("_head").eqNullSafe(F.lag("_tail").over(Window.partitionBy(key).orderBy("span")))
    # newest change within a span, its first row counted only if it differs from the row before
    each = each.withColumn("_goes_on", goes_on).withColumn("_newest", F.coalesce("_last", F.when(~F.col("_goes_on"), F.col("_from"))))
    inside = F.when(F.col("_goes_on"), F.max("_newest").over(earlier(key))).otherwise(F.col("_from"))
    spans = each.select(F.col(key).alias("_k"), F.col("span").alias("_s"), inside.alias("_at"))
    met = marked.join(spans, F.col(key).eqNullSafe(F.col("_k")) & (F.col("span") == F.col("_s")), "left")
    since = F.greatest(F.max(F.when(~F.col("_first"), F.col("_start"))).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_at"))
    return met.withColumn(name, (F.col(pos) - since + 1).cast("int")).drop("_first", "_start", "_k", "_s", "_at")


def scan_length(span: int, length: int = LENGTH) -> int:
    """The longest span up to `length` over which the weights of a mean of the given span stay in range."""
    return max(1, min(length, int(POWER / -math.log(1 - 2.0 / (span + 1))))) if span > 1 else length


def ewm_means(df: DataFrame, key: str, pos: str, columns: dict[str, tuple[Column, int]]) -> DataFrame:
    """Recursive exponential means y = a x + (1 - a) y of a series in spans: name -> (values, mean's span). A mean starts at the
    first value that is not null and is null until as many values as its span have come; nulls leave it as it is.

    A span that starts from y ends at A y + B, with A = (1 - a)^m for its m values and B its mean from zero. Within a span both are
    running sums, B = (1 - a)^m sum(a x (1 - a)^-m). Spans must not be longer than scan_length() says."""
    w = in_span(key, pos)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    local, summary = {}, {}
    for n, (x, span) in columns.items():
        keep = 1 - 2.0 / (span + 1)
        m = F.count(x).over(up)
        local |= {f"_m_{n}": m, f"_b_{n}": F.pow(F.lit(keep), m) * F.coalesce(F.sum(f"_t_{n}").over(up), F.lit(0.0))}
        summary |= {f"_sm_{n}": F.max(f"_m_{n}"), f"_sb_{n}": F.max_by(f"_b_{n}", F.col(pos)), f"_sx_{n}": F.min_by(f"_x_{n}", F.when(F.col(f"_x_{n}").isNotNull(), F.col(pos)))}
    df = df.withColumns({f"_x_{n}": x for n, (x, _) in columns.items()})
    terms = {f"_t_{n}": F.col(f"_x_{n}") * (2.0 / (s + 1)) * F.pow(F.lit(1 - 2.0 / (s + 1)), -F.count(f"_x_{n}").over(up)) for n, (_, s) in columns.items()}
    df = df.withColumns(terms).withColumns(local)
    each = df.groupBy(key, "span").agg(*[c.alias(n) for n, c in summary.items()])
    names, spans = each.columns, {n: s for n, (_, s) in columns.items()}

    def fold(state: dict, rows: pa.RecordBatch) -> list:
        """The mean and the number of values before each span, span after span."""
        out = []
        for n, span in spans.items():
            keep = 1 - 2.0 / (span + 1)
            y, c = state.get(n, (None, 0))
            ys, cs = [], []
            for m, b, x in zip(*(rows.column(names.index(f"{p}_{n}")).to_pylist() for p in ("_sm", "_sb", "_sx"))):
                ys.append(y)
                cs.append(c)
                if m:
                    y, c = keep**m * (x if y is None else y) + b, c + m  # a mean that has not begun begins with the first value
            state[n] = y, c
            out += [pa.array(ys, pa.float64()), pa.array(cs, pa.int64())]
        return out

    states = streamed(each, key, "span", ", ".join(f"`_y_{n}` double, `_c_{n}` long" for n in columns), fold)
    incoming = states.select(F.col(key).alias("_k"), F.col("span").alias("_s"), *[f"{p}_{n}" for n in columns for p in ("_y", "_c")])
    met = df.join(incoming, F.col(key).eqNullSafe(F.col("_k")) & (F.col("span") == F.col("_s")), "left")
    out = {}
    for n, (_, span) in columns.items():
        first = F.first(F.col(f"_x_{n}"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        y = F.pow(F.lit(1 - 2.0 / (span + 1)), F.col(f"_m_{n}")) * F.coalesce(F.col(f"_y_{n}"), first) + F.col(f"_b_{n}")
        y = F.when(F.col(f"_m_{n}") > 0, y).otherwise(F.col(f"_y_{n}"))
        out[n] = F.when(F.col(f"_c_{n}") + F.col(f"_m_{n}") >= span, y)
    return met.withColumns(out).drop("_k", "_s", *[f"{p}_{n}" for n in columns for p in ("_x", "_t", "_m", "_b", "_y", "_c")])


class SortedWindow:
    """The last n values in order, as a list of short sorted lists: a value comes and the oldest goes in about sqrt(n) steps, and
    so is counted how many are smaller than a value."""

    SHORT = 512

    def __init__(self, n: int):
        self.n, self.at, self.ring, self.parts = n, 0, [], [[]]

    def add(self, x: float) -> None:
        if len(self.ring) < self.n:
            self.ring.append(x)
        else:
            self._remove(self.ring[self.at])
            self.ring[self.at] = x
            self.at = (self.at + 1) % self.n
        i = self._part(x)
        insort(self.parts[i], x)
        if len(self.parts[i]) > 2 * self.SHORT:
            self.parts[i : i + 1] = [self.parts[i][: self.SHORT], self.parts[i][self.SHORT :]]

    def _part(self, x: float) -> int:
        """The first part whose largest value is not below x, else the last."""
        for i, p in enumerate(self.parts):
            if p and p[-1] >= x:
                return i
        return len(self.parts) - 1

    def _remove(self, x: float) -> None:
        i = self._part(x)
        del self.parts[i][bisect_left(self.parts[i], x)]
        if not self.parts[i] and len(self.parts) > 1:
            del self.parts[i]

    def below(self, x: float) -> int:
        count = 0
        for p in self.parts:
            if p and p[-1] >= x:
                return count + bisect_left(p, x)
            count += len(p)
        return count


def trailing_below(df: DataFrame, key: str, pos: str, columns: dict[str, str], n: int, length: int = LENGTH) -> DataFrame:
    """How many of the last n rows, this one counted, lie strictly below the row's own value: name -> source column, null where the
    value is null; nulls among the rows lie below nothing. Each span slides an ordered window over its rows and the n - 1 before."""
    names = list(df.columns)
    spread = with_halo(df, pos, n - 1, length).withColumn("_part", F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(key).isNull().cast("string"), F.col("span")))
    at = {name: spread.columns.index(source) for name, source in columns.items()}

    def work(state: dict, rows: pa.RecordBatch) -> list:
        out = []
        for name, i in at.items():
            window = state.setdefault(name, SortedWindow(n))
            counts = []
            for x in rows.column(i).to_pylist():
                window.add(math.inf if x is None else x)
                counts.append(None if x is None else window.below(x))
            out.append(pa.array(counts, pa.int64()))
        return out

    counted = streamed(spread, "_part", pos, ", ".join(f"`{name}` long" for name in columns), work)
    return counted.where("own").select(*names, *columns)
