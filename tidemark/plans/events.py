"""Consolidation events on hourly bars: detection, barrier labels, window features, scoring, and trades simulated on them.

A bar consolidates when both its 60-bar range and the slope of its log price are at or under the ticker's 55th percentiles.
Runs of at least two such bars are events; each is labelled by the barrier that the next 40 bars reach first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_div
from tidemark.operators.quantiles import exact_percentile
from tidemark.operators.series import forward, islands, numbered, rolling, series
from tidemark.plans.gold_chain import select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.sources import adapters

# Fixed values of the event definition.
W, BEFORE, QUANTILE, MOVE, HORIZON, BARRIER, BAND_LOW, BAND_HIGH = 60, 120, 0.55, 0.03, 40, 1.5, 0.002, 0.05


def base_series(bars: DataFrame, window: int = W, before: int = BEFORE) -> DataFrame:
    """Range, slope, volatility and volume of the last `window` bars, and the move over `before` bars."""
    w = series("ticker", "ts")
    c, h, l, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume").cast("double")
    prev = F.lag("close").over(w)
    df = numbered(bars.where((h >= l) & (l > 0) & c.isNotNull()), "ticker", "ts").withColumns({
        "ret": F.log(c / prev), "tr": F.when(prev.isNotNull(), F.greatest(h - l, F.abs(h - prev), F.abs(l - prev))), "log_close": F.log(c), "r_pre": c / F.lag("close", before).over(w) - 1,
    })
    frame = w.rowsBetween(-(window - 1), 0)
    return df.withColumns({
        "atr": rolling(F.avg, F.col("tr"), w, 14, 1), "range_width": (F.max(h).over(frame) - F.min(l).over(frame)) / c, "slope": F.when(F.count("log_close").over(frame) >= 2, F.regr_slope(F.col("log_close"), F.col("idx").cast("double")).over(frame)),
        "vol": rolling(F.stddev_samp, F.col("ret"), w, window, 2), "rel_volume": safe_div(v, F.avg(v).over(frame)),
    })


def consolidation(base: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    # both measures' percentiles in one selection: a ticker's series has no bound, so its values are not gathered
    measures = base.where("slope is not null").select("ticker", F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), c.alias("value")) for n, c in (("range", F.col("range_width")), ("slope", F.abs("slope")))])))
    found = exact_percentile(measures, ["ticker", "measure"], "value", quantile, "most")
    limits = found.groupBy("ticker").agg(*[F.max(F.when(F.col("measure") == n, F.col("most"))).alias(f"max_{n}") for n in ("range", "slope")])
    near = 1 + 1e-9  # the thresholds are themselves values of the series
    return base.join(limits, "ticker").withColumn("flat", F.coalesce((F.col("range_width") <= F.col("max_range") * near) & (F.abs("slope") <= F.col("max_slope") * near), F.lit(False)))


def events_of(flat: DataFrame, least: int = 2) -> DataFrame:
    """One row per run of consolidating bars that has a move before it."""
    runs = islands(flat, "ticker", "ts", F.col("flat"), "run").where("run is not null")
    first, last = lambda c: F.min_by(c, "idx"), lambda c: F.max_by(c, "idx")
    ev = runs.groupBy("ticker", "run").agg(F.count("*").alias("bars"), F.min("ts").alias("run_start"), F.max("ts").alias("t_end"), last("idx").alias("end_idx"), first("r_pre").alias("r_pre"), last("close").alias("close_end"), last("atr").alias("atr_end"), last("slope").alias("slope_end"), last("range_width").alias("range_end"))
    r = F.col("r_pre")
    return ev.where((F.col("bars") >= least) & r.isNotNull()).withColumn("prior_dir", F.when(r > MOVE, 1).when(r < -MOVE, -1).otherwise(0))


def first_hits(ahead: DataFrame, keys: list[str], up: Column, down: Column) -> DataFrame:
    """Per event the first step at which each barrier is reached, the number of bars seen, and the last close."""
    return ahead.groupBy(*keys).agg(F.min(F.when(up, F.col("step"))).alias("up_step"), F.min(F.when(down, F.col("step"))).alias("down_step"), F.count("*").alias("future_bars"), F.max_by("f_close", "step").alias("last_close"), F.max("step").alias("last_step"))


def labelled(events: DataFrame, bars: DataFrame, k: float = BARRIER, horizon: int = HORIZON) -> DataFrame:
    band = F.col("atr_end") * k
    ahead = forward(events, bars, "ticker", "end_idx", horizon, ["high", "low", "close"])
    hits = first_hits(ahead, ["ticker", "run"], F.col("f_high") >= F.col("close_end") + band, F.col("f_low") <= F.col("close_end") - band)
    u, d, prior, label = F.col("up_step"), F.col("down_step"), F.col("prior_dir"), F.col("label")
    pct = band / F.col("close_end")
    return events.join(hits, ["ticker", "run"]).withColumns({"band_pct": pct, "label_valid": F.col("future_bars") >= horizon, "label": F.when(u < d, "UP_RESOLVE").when(d < u, "DOWN_RESOLVE").when(u.isNotNull() & d.isNull(), "UP_RESOLVE").when(d.isNotNull() & u.isNull(), "DOWN_RESOLVE").otherwise("NO_RESOLVE")}).withColumn(
        "acc_dist", F.when((prior == -1) & (label == "UP_RESOLVE"), "ACCUMULATION").when((prior == 1) & (label == "DOWN_RESOLVE"), "DISTRIBUTION").otherwise("OTHER")
    ).where(pct.between(BAND_LOW, BAND_HIGH))


def window_features(events: DataFrame, bars: DataFrame, window: int = W) -> DataFrame:
    """Features of the last `window` bars up to each event's end: range, volume by direction, effort against result, where
    bars close, quartile shares, wick rejections, streaks and net return."""
    back = forward(events.withColumn("from_idx", F.col("end_idx") - window), bars, "ticker", "from_idx", window, ["open", "high", "low", "close", "volume"])
    keys = ["ticker", "run"]
    whole = Window.partitionBy(*keys)
    o, h, l, c, v = (F.col(f"f_{x}") for x in ("open", "high", "low", "close", "volume"))
    seq = whole.orderBy("step")
    b = back.withColumns({"hi": F.max(h).over(whole), "lo": F.min(l).over(whole), "chg": c - F.lag(c).over(seq), "place": F.row_number().over(seq)})
    pos = safe_div(c - F.col("lo"), F.col("hi") - F.col("lo"))
    side = F.signum(F.coalesce(F.col("chg"), F.lit(0.0)))
    b = b.withColumns({"pos": pos, "clv": safe_div((c - l) - (h - c), h - l), "side": side}).withColumn("new_side", (F.coalesce(F.lag("side").over(seq), F.lit(9.0)) != F.col("side")).cast("int"))
    b = b.withColumn("streak", F.sum("new_side").over(seq.rowsBetween(Window.unboundedPreceding, 0)))
    b = b.withColumn("streak_len", F.count("*").over(Window.partitionBy(*keys, "streak")))
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    vol = F.sum(v)
    return b.groupBy(*keys).agg(
        safe_div(F.max("hi") - F.min("lo"), F.max_by(c, "step")).alias("range_pct"), safe_div(F.sum(F.when(side > 0, v).otherwise(0)), vol).alias("up_volume_share"), safe_div(vol, F.abs(F.max_by(c, "step") - F.min_by(c, "step")) + 1e-9).alias("effort_result"),
        F.avg("clv").alias("clv_mean"), F.max_by("pos", "step").alias("pos_end"), share(F.col("pos") >= 0.75).alias("top_quartile_share"), share(F.col("pos") <= 0.25).alias("bottom_quartile_share"),
        F.avg(safe_div(h - F.greatest(o, c), h - l)).alias("upper_wick"), F.avg(safe_div(F.least(o, c) - l, h - l)).alias("lower_wick"), F.max(F.when(side > 0, F.col("streak_len")).otherwise(0)).alias("up_streak"),
        F.max(F.when(side < 0, F.col("streak_len")).otherwise(0)).alias("down_streak"), (safe_div(F.max_by(c, "step"), F.min_by(c, "step")) - 1).alias("net_return"), F.regr_slope(c, F.col("place").cast("double")).alias("price_slope"),
        F.regr_slope(v.cast("double"), F.col("place").cast("double")).alias("volume_slope"), F.count("*").alias("window_bars"),
    )


def all_events(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    base = base_series(bars)
    return events_of(consolidation(base)), base


EVENT = {"ticker": None, "t_end": None, "bars": None, "r_pre": 6, "prior_dir": None, "close_end": 4, "atr_end": 6, "band_pct": 6, "future_bars": None, "label_valid": None, "label": None, "acc_dist": None, "up_step": None, "down_step": None}
EVENT_CTE = f"""
e1 AS (SELECT *, row_number() OVER w AS idx, lag(close) OVER w AS prev, ln(close) AS lc, close / lag(close, {BEFORE}) OVER w - 1 AS r_pre FROM bars_hourly WHERE high >= low AND low > 0 WINDOW w AS (PARTITION BY ticker ORDER BY ts)),
e2 AS (SELECT *, CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr FROM e1),
e3 AS (SELECT *, avg(tr) OVER (PARTITION BY ticker ORDER BY ts ROWS 13 PRECEDING) AS atr, (max(high) OVER f - min(low) OVER f) / close AS range_width, CASE WHEN idx >= 2 THEN regr_slope(lc, CAST(idx AS DOUBLE)) OVER f END AS slope
       FROM e2 WINDOW f AS (PARTITION BY ticker ORDER BY ts ROWS {W - 1} PRECEDING)),
lim AS (SELECT ticker, quantile_cont(range_width, {QUANTILE}) AS max_range, quantile_cont(abs(slope), {QUANTILE}) AS max_slope FROM e3 WHERE slope IS NOT NULL GROUP BY ticker),
e4 AS (SELECT e3.*, coalesce(range_width <= max_range * (1 + 1e-9) AND abs(slope) <= max_slope * (1 + 1e-9), false) AS flat FROM e3 JOIN lim USING (ticker)),
e5 AS (SELECT *, idx - row_number() OVER (PARTITION BY ticker ORDER BY ts) AS isle FROM e4 WHERE flat),
ev AS (SELECT ticker, isle, count(*) AS bars, max(ts) AS t_end, max(idx) AS end_idx, arg_min(r_pre, idx) AS r_pre, arg_max(close, idx) AS close_end, arg_max(atr, idx) AS atr_end, arg_max(slope, idx) AS slope_end, arg_max(range_width, idx) AS range_end FROM e5 GROUP BY ticker, isle HAVING count(*) >= 2),
e6 AS (SELECT *, CASE WHEN r_pre > {MOVE} THEN 1 WHEN r_pre < -{MOVE} THEN -1 ELSE 0 END AS prior_dir, atr_end * {BARRIER} AS band FROM (SELECT DISTINCT ON (ticker, t_end) * FROM ev) x WHERE (SELECT r_pre FROM e3 WHERE e3.ticker = x.ticker AND e3.idx = x.end_idx - x.bars + 1) IS NOT NULL),
hit AS (SELECT v.ticker, v.end_idx, min(b.idx - v.end_idx) FILTER (b.high >= close_end + band) AS up_step, min(b.idx - v.end_idx) FILTER (b.low <= close_end - band) AS down_step, count(*) AS future_bars
        FROM e6 v JOIN e3 b ON b.ticker = v.ticker AND b.idx > v.end_idx AND b.idx <= v.end_idx + {HORIZON} GROUP BY 1, 2),
ev_labels AS (SELECT *, band / close_end AS band_pct, future_bars >= {HORIZON} AS label_valid, CASE WHEN coalesce(up_step, 99) < coalesce(down_step, 99) THEN 'UP_RESOLVE' WHEN coalesce(down_step, 99) < coalesce(up_step, 99) THEN 'DOWN_RESOLVE' ELSE 'NO_RESOLVE' END AS label FROM e6 JOIN hit USING (ticker, end_idx)),
event_rows AS (SELECT *, CASE WHEN prior_dir = -1 AND label = 'UP_RESOLVE' THEN 'ACCUMULATION' WHEN prior_dir = 1 AND label = 'DOWN_RESOLVE' THEN 'DISTRIBUTION' ELSE 'OTHER' END AS acc_dist FROM ev_labels WHERE band_pct BETWEEN {BAND_LOW} AND {BAND_HIGH})"""


def hourly(spark, sf_dir) -> DataFrame:
    return adapters.load(spark, sf_dir, "bars_hourly")


@register("consolidation_events", f"WITH {adapters.oracle('bars_hourly')},{EVENT_CTE} SELECT {sql_rounded(EVENT)} FROM event_rows")
def consolidation_events_query(spark, sf_dir):
    ev, base = all_events(hourly(spark, sf_dir))
    out = labelled(ev, base)
    return select_rounded(out.withColumns({"up_step": F.col("up_step").cast("long"), "down_step": F.col("down_step").cast("long")}), EVENT)


FEATURES = {"ticker": None, "t_end": None} | {c: 6 for c in "range_pct up_volume_share effort_result clv_mean pos_end top_quartile_share bottom_quartile_share upper_wick lower_wick net_return price_slope volume_slope".split()} | {"up_streak": None, "down_streak": None, "window_bars": None}


@register(
    "event_window_features",
    f"""
WITH {adapters.oracle("bars_hourly")},{EVENT_CTE},
bk AS (SELECT v.ticker, v.end_idx, v.t_end, b.*  EXCLUDE (ticker), row_number() OVER (PARTITION BY v.ticker, v.end_idx ORDER BY b.idx) AS place, close - lag(close) OVER (PARTITION BY v.ticker, v.end_idx ORDER BY b.idx) AS chg,
         max(high) OVER (PARTITION BY v.ticker, v.end_idx) AS hi, min(low) OVER (PARTITION BY v.ticker, v.end_idx) AS lo FROM e6 v JOIN e3 b ON b.ticker = v.ticker AND b.idx > v.end_idx - {W} AND b.idx <= v.end_idx),
bs AS (SELECT *, sign(coalesce(chg, 0)) AS side, (close - lo) / nullif(hi - lo, 0) AS pos, place - row_number() OVER (PARTITION BY ticker, end_idx, sign(coalesce(chg, 0)) ORDER BY place) AS isle FROM bk),
bl AS (SELECT *, count(*) OVER (PARTITION BY ticker, end_idx, side, isle) AS streak_len FROM bs),
ft AS (SELECT ticker, t_end, (max(hi) - min(lo)) / arg_max(close, idx) AS range_pct, sum(CASE WHEN side > 0 THEN volume ELSE 0 END) / sum(volume) AS up_volume_share, sum(volume) / (abs(arg_max(close, idx) - arg_min(close, idx)) + 1e-9) AS effort_result,
         avg(((close - low) - (high - close)) / nullif(high - low, 0)) AS clv_mean, arg_max(pos, idx) AS pos_end, avg(if(pos >= 0.75, 1, 0)) AS top_quartile_share, avg(if(pos <= 0.25, 1, 0)) AS bottom_quartile_share,
         avg((high - greatest(open, close)) / nullif(high - low, 0)) AS upper_wick, avg((least(open, close) - low) / nullif(high - low, 0)) AS lower_wick, arg_max(close, idx) / arg_min(close, idx) - 1 AS net_return, regr_slope(close, CAST(place AS DOUBLE)) AS price_slope,
         regr_slope(CAST(volume AS DOUBLE), CAST(place AS DOUBLE)) AS volume_slope, max(if(side > 0, streak_len, 0)) AS up_streak, max(if(side < 0, streak_len, 0)) AS down_streak, count(*) AS window_bars FROM bl GROUP BY ticker, t_end, end_idx)
SELECT {sql_rounded(FEATURES)} FROM ft""",
)
def event_window_features_query(spark, sf_dir):
    ev, base = all_events(hourly(spark, sf_dir))
    out = window_features(ev, base).join(ev.select("ticker", "run", "t_end"), ["ticker", "run"])
    return select_rounded(out.withColumns({"up_streak": F.col("up_streak").cast("long"), "down_streak": F.col("down_streak").cast("long")}), FEATURES)


# Trades

ATR_TARGET, ATR_STOP, HOLD = 1.5, 1.0, 20
SIZE, FEE = 10_000.0, 10.0


def score(events: DataFrame) -> DataFrame:
    """Probability of an upward resolution by a fixed logistic rule over the event's own values, and the side taken."""
    z = -12 * F.col("r_pre") + 400 * F.col("slope_end") + 2 * (F.col("range_end") - 0.2)
    p = 1 / (1 + F.exp(-z))
    return events.withColumn("p_up", F.round(p, 9)).withColumn("side", F.when(F.col("p_up") >= 0.55, "LONG").when(F.col("p_up") <= 0.45, "SHORT"))


def trades(signals: DataFrame, bars: DataFrame, target: float = ATR_TARGET, stop: float = ATR_STOP, hold: int = HOLD, slip_bps: float | Column = 0.0, target_first: bool = True, by: list[str] | None = None) -> DataFrame:
    """Entry at the open of the next bar, exit at target, stop, or the close of the last of `hold` bars. A bar that reaches
    both counts as the one that target_first names; slippage worsens entry and exit. Open trades lack bars and a result. Signals
    that come several times are told apart by the columns `by`."""
    s = signals.where("side is not null")
    d = F.when(F.col("side") == "LONG", 1.0).otherwise(-1.0)
    ahead = forward(s.withColumn("d", d), bars, "ticker", "end_idx", hold + 1, ["open", "high", "low", "close"])
    keys = ["ticker", "run", *(by or [])]
    ahead = ahead.withColumn("entry", F.max(F.when(F.col("step") == 1, F.col("f_open"))).over(Window.partitionBy(*keys)) * (1 + F.col("d") * slip_bps / 10_000))
    up, down = F.col("entry") + F.col("d") * target * F.col("atr_end"), F.col("entry") - F.col("d") * stop * F.col("atr_end")
    won = F.when(F.col("d") > 0, F.col("f_high") >= up).otherwise(F.col("f_low") <= up)
    lost = F.when(F.col("d") > 0, F.col("f_low") <= down).otherwise(F.col("f_high") >= down)
    held = ahead.where(F.col("step") <= hold)
    hits = held.groupBy(*keys, "t_end", "side", "d", "p_up", "entry").agg(F.min(F.when(won, F.col("step"))).alias("won"), F.min(F.when(lost, F.col("step"))).alias("lost"), F.count("*").alias("seen"), F.max_by("f_close", "step").alias("last_close"), F.first("atr_end").alias("atr"))
    w, x = F.coalesce("won", F.lit(10_000)), F.coalesce("lost", F.lit(10_000))
    first = (w <= x) if target_first else (w < x)
    kind = F.when((F.least(w, x) < 10_000) & first, "TARGET").when(F.least(w, x) < 10_000, "STOP").when(F.col("seen") >= hold, "TIME").otherwise("OPEN")
    out = hits.withColumns({"exit_type": kind, "bars_held": F.when(kind.isin("TARGET", "STOP"), F.least(w, x)).otherwise(F.col("seen")).cast("long")})
    raw = F.when(F.col("exit_type") == "TARGET", F.col("entry") + F.col("d") * target * F.col("atr")).when(F.col("exit_type") == "STOP", F.col("entry") - F.col("d") * stop * F.col("atr")).when(F.col("exit_type") == "TIME", F.col("last_close"))
    out = out.withColumn("exit_price", raw * (1 - F.col("d") * slip_bps / 10_000)).withColumn("pnl_pct", F.col("d") * (F.col("exit_price") / F.col("entry") - 1) * 100)
    return out.withColumn("pnl_eur", SIZE * F.col("pnl_pct") / 100 - FEE)


TRADE = {"ticker": None, "t_end": None, "side": None, "p_up": 6, "entry": 4, "exit_type": None, "bars_held": None, "exit_price": 4, "pnl_pct": 4, "pnl_eur": 2}
TRADE_CTE = f"""{EVENT_CTE},
sg AS (SELECT *, round(1 / (1 + exp(-(-12 * r_pre + 400 * slope_end + 2 * (range_end - 0.2)))), 9) AS p_up FROM e6),
sd AS (SELECT *, CASE WHEN p_up >= 0.55 THEN 'LONG' WHEN p_up <= 0.45 THEN 'SHORT' END AS side, CASE WHEN p_up >= 0.55 THEN 1 ELSE -1 END AS d FROM sg WHERE p_up >= 0.55 OR p_up <= 0.45),
en AS (SELECT sd.*, b.open AS entry FROM sd JOIN e3 b ON b.ticker = sd.ticker AND b.idx = sd.end_idx + 1),
th AS (SELECT en.ticker, en.end_idx, en.t_end, side, d, p_up, entry, atr_end, min(b.idx - en.end_idx) FILTER (CASE WHEN d > 0 THEN b.high >= entry + {ATR_TARGET} * atr_end ELSE b.low <= entry - {ATR_TARGET} * atr_end END) AS won,
         min(b.idx - en.end_idx) FILTER (CASE WHEN d > 0 THEN b.low <= entry - {ATR_STOP} * atr_end ELSE b.high >= entry + {ATR_STOP} * atr_end END) AS lost, count(*) AS seen, arg_max(b.close, b.idx) AS last_close
       FROM en JOIN e3 b ON b.ticker = en.ticker AND b.idx > en.end_idx AND b.idx <= en.end_idx + {HOLD} GROUP BY ALL),
tk AS (SELECT *, CASE WHEN won IS NOT NULL AND won <= coalesce(lost, 10000) THEN 'TARGET' WHEN lost IS NOT NULL THEN 'STOP' WHEN seen >= {HOLD} THEN 'TIME' ELSE 'OPEN' END AS exit_type FROM th),
tx AS (SELECT *, CASE exit_type WHEN 'TARGET' THEN won WHEN 'STOP' THEN lost ELSE seen END AS bars_held, CASE exit_type WHEN 'TARGET' THEN entry + d * {ATR_TARGET} * atr_end WHEN 'STOP' THEN entry - d * {ATR_STOP} * atr_end WHEN 'TIME' THEN last_close END AS exit_price FROM tk),
tp AS (SELECT *, d * (exit_price / entry - 1) * 100 AS pnl_pct FROM tx),
trade_rows AS (SELECT *, {SIZE} * pnl_pct / 100 - {FEE} AS pnl_eur FROM tp)"""


def all_trades(spark, sf_dir, **policy) -> DataFrame:
    ev, base = all_events(hourly(spark, sf_dir))
    return trades(score(ev), base, **policy)


@register("event_trades", f"WITH {adapters.oracle('bars_hourly')},{TRADE_CTE} SELECT {sql_rounded(TRADE)} FROM trade_rows")
def event_trades_query(spark, sf_dir):
    return select_rounded(all_trades(spark, sf_dir), TRADE)


def trade_summary(closed: DataFrame) -> DataFrame:
    """Per ticker: trades, win rate, mean, spread, profit factor, compounded return, deepest fall of the running product."""
    done = closed.where("pnl_pct is not null")
    w = series("ticker", "t_end").rowsBetween(Window.unboundedPreceding, 0)
    curve = done.withColumn("log_equity", F.sum(F.log1p(F.col("pnl_pct") / 100)).over(w))
    curve = curve.withColumn("fall", 1 - F.exp(F.col("log_equity") - F.greatest(F.max("log_equity").over(w), F.lit(0.0))))
    p = F.col("pnl_eur")
    return curve.groupBy("ticker").agg(
        F.count("*").alias("n_trades"), (F.avg((p > 0).cast("double")) * 100).alias("win_rate"), F.avg("pnl_pct").alias("mean_pct"), F.stddev_samp("pnl_pct").alias("std_pct"), F.sum("pnl_eur").alias("total_eur"),
        safe_div(F.sum(F.when(p > 0, p).otherwise(0.0)), -F.sum(F.when(p < 0, p).otherwise(0.0))).alias("profit_factor"), (F.exp(F.sum(F.log1p(F.col("pnl_pct") / 100))) - 1).alias("compounded"), F.max("fall").alias("max_drawdown"),
        F.count(F.when(F.col("exit_type") == "TARGET", 1)).alias("targets"), F.count(F.when(F.col("exit_type") == "STOP", 1)).alias("stops"), F.count(F.when(F.col("exit_type") == "TIME", 1)).alias("time_exits"), F.avg("bars_held").alias("mean_bars"),
    )


SUMMARY = {"ticker": None, "n_trades": None, "win_rate": 4, "mean_pct": 4, "std_pct": 4, "total_eur": 2, "profit_factor": 4, "compounded": 6, "max_drawdown": 6, "targets": None, "stops": None, "time_exits": None, "mean_bars": 4}


@register(
    "trade_summary",
    f"""
WITH {adapters.oracle("bars_hourly")},{TRADE_CTE},
cu AS (SELECT *, sum(ln(1 + pnl_pct / 100)) OVER w AS eq FROM trade_rows WHERE pnl_pct IS NOT NULL WINDOW w AS (PARTITION BY ticker ORDER BY t_end ROWS UNBOUNDED PRECEDING)),
dd AS (SELECT *, 1 - exp(eq - greatest(max(eq) OVER (PARTITION BY ticker ORDER BY t_end ROWS UNBOUNDED PRECEDING), 0)) AS fall FROM cu),
su AS (SELECT ticker, count(*) AS n_trades, avg(if(pnl_eur > 0, 1, 0)) * 100 AS win_rate, avg(pnl_pct) AS mean_pct, CASE WHEN count(*) > 1 THEN stddev_samp(pnl_pct) END AS std_pct, sum(pnl_eur) AS total_eur,
         sum(if(pnl_eur > 0, pnl_eur, 0)) / nullif(-sum(if(pnl_eur < 0, pnl_eur, 0)), 0) AS profit_factor, exp(sum(ln(1 + pnl_pct / 100))) - 1 AS compounded, max(fall) AS max_drawdown, count(*) FILTER (exit_type = 'TARGET') AS targets,
         count(*) FILTER (exit_type = 'STOP') AS stops, count(*) FILTER (exit_type = 'TIME') AS time_exits, avg(bars_held) AS mean_bars FROM dd GROUP BY ticker)
SELECT {sql_rounded(SUMMARY)} FROM su""",
)
def trade_summary_query(spark, sf_dir):
    return select_rounded(trade_summary(all_trades(spark, sf_dir)), SUMMARY)


def sharpe_by_frequency(mean: Column, std: Column, per_year: Column) -> Column:
    return safe_div(mean, std) * F.sqrt(per_year)


def sharpe_by_days(mean: Column, std: Column) -> Column:
    return safe_div(mean, std) * math.sqrt(252)


def sharpe_plain(mean: Column, std: Column) -> Column:
    return safe_div(mean, std)
