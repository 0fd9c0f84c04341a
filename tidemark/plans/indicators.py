"""Technical indicators over daily bars, and the market regimes classified from them.

A ticker's series is cut into spans of SPAN bars. Windows of a fixed number of bars see a span with the LOOK_BACK bars before it;
cumulative and recursive values are scans that carry one row a span. A rolling value is null until its window is full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_div
from tidemark.operators.rows import latest_by
from tidemark.operators.series import rolling, series
from tidemark.operators.spans import ewm_means, in_span, positioned, run_lengths, running_sums, span_of, trailing_below, with_halo
from tidemark.plans.gold_chain import select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.session import stored
from tidemark.sources import adapters

YEAR = 252
SPAN, LOOK_BACK = 1024, 260  # bars; the longest look-back is a year of bars and the one before
PERIOD_YEARS = 4  # bars are counted by so many years of a ticker


def sma(c: Column, n: int, w) -> Column:
    return rolling(F.avg, c, w, n)


def technical_indicators(bars: DataFrame) -> DataFrame:
    """Averages, momentum, volatility, volume and trend strength for bars (ticker, trade_date, open .. close, volume); bar is a row's
    position in its ticker's series, span the run of positions that it lies in."""
    c, h, l, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume").cast("double")
    w, prev = in_span("ticker", "bar"), F.col("prev")
    placed = with_halo(positioned(bars, "ticker", "trade_date", F.floor(F.year("trade_date") / PERIOD_YEARS), "bar"), "bar", 1, SPAN)
    lagged = placed.withColumns({"prev": F.lag("close").over(w), "prev_high": F.lag("high").over(w), "prev_low": F.lag("low").over(w)})
    # the scans come first, over few columns that are stored since each scan reads them twice
    base = stored(lagged.where("own").drop("own").withColumn("signed_volume", F.coalesce(F.signum(c - prev), F.lit(0.0)) * v))
    base = running_sums(base, "ticker", "bar", {"obv": F.col("signed_volume")})
    base = ewm_means(base, "ticker", "bar", {"ema_12": (c, 12), "ema_26": (c, 26)}).withColumn("macd", F.col("ema_12") - F.col("ema_26"))
    base = ewm_means(base, "ticker", "bar", {"macd_signal": (F.col("macd"), 9)}).drop("span")
    parts = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # spans are few and dear: not to be put together again
    base = with_halo(base, "bar", LOOK_BACK, SPAN).repartition(parts, "ticker", "span")
    up, down = h - F.col("prev_high"), F.col("prev_low") - l
    plus = F.when((up > down) & (up > 0), up).otherwise(0.0)
    # the minus move is held against the plus move as already filtered, so equal positive moves count as minus
    minus = F.when((down > plus) & (down > 0), down).otherwise(0.0)
    base = base.withColumns({
        "gain": F.greatest(F.coalesce(c - prev, F.lit(0.0)), F.lit(0.0)), "loss": F.greatest(F.coalesce(prev - c, F.lit(0.0)), F.lit(0.0)), "tr": F.greatest(h - l, F.abs(h - prev), F.abs(l - prev)), "ret": c / prev - 1,
        "range2": F.pow(F.log(h / l), 2), "plus_dm": plus, "minus_dm": minus,
    })
    gain, loss = rolling(F.avg, F.col("gain"), w, 14), rolling(F.avg, F.col("loss"), w, 14)
    hh, ll = rolling(F.max, h, w, 14), rolling(F.min, l, w, 14)
    tr14 = rolling(F.sum, F.col("tr"), w, 14)
    mid, sd = sma(c, 20, w), rolling(F.stddev_samp, c, w, 20)
    out = base.withColumns({
        "sma_20": sma(c, 20, w), "sma_50": sma(c, 50, w), "sma_200": sma(c, 200, w), "rsi_14": F.when(loss > 0, 100 - 100 / (1 + gain / F.nullif(loss, F.lit(0.0)))).when(gain > 0, 100.0),
        "stoch_k": safe_div(c - ll, hh - ll) * 100, "roc_20": (safe_div(c, F.lag("close", 20).over(w)) - 1) * 100, "atr_14": rolling(F.avg, F.col("tr"), w, 14), "bb_middle": mid, "bb_upper": mid + 2 * sd, "bb_lower": mid - 2 * sd,
        "bb_width": 4 * sd, "realized_vol_20": rolling(F.stddev_samp, F.col("ret"), w, 20) * F.sqrt(F.lit(float(YEAR))) * 100,
        "parkinson_vol_20": F.sqrt(rolling(F.avg, F.col("range2"), w, 20) / (4 * F.log(F.lit(2.0)))) * F.sqrt(F.lit(float(YEAR))) * 100, "high_20d": rolling(F.max, h, w, 20), "low_20d": rolling(F.min, l, w, 20),
        "high_52w": rolling(F.max, h, w, YEAR, 100), "low_52w": rolling(F.min, l, w, YEAR, 100), "volume_sma_20": sma(v, 20, w),
        "plus_di_14": safe_div(rolling(F.sum, F.col("plus_dm"), w, 14), tr14) * 100, "minus_di_14": safe_div(rolling(F.sum, F.col("minus_dm"), w, 14), tr14) * 100,
    })
    p, m = F.col("plus_di_14"), F.col("minus_di_14")
    out = out.withColumn("dx", safe_div(F.abs(p - m), p + m) * 100)
    out = out.withColumns({
        "stoch_d": sma(F.col("stoch_k"), 3, w), "adx_14": sma(F.col("dx"), 14, w), "obv_sma_20": sma(F.col("obv"), 20, w), "volume_ratio": safe_div(v, F.col("volume_sma_20")), "pct_from_high_20d": safe_div(c - F.col("high_20d"), F.col("high_20d")) * 100,
        "pct_from_low_52w": safe_div(c - F.col("low_52w"), F.col("low_52w")) * 100,
    })
    return out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).where("own and sma_20 is not null").drop("own")


INDICATORS = {"ticker": None, "trade_date": None, "close": 4, "volume": None} | {
    c: 4
    for c in "sma_20 sma_50 sma_200 ema_12 ema_26 macd macd_signal macd_histogram rsi_14 stoch_k stoch_d roc_20 atr_14 bb_upper bb_middle bb_lower bb_width realized_vol_20 parkinson_vol_20 high_20d low_20d high_52w low_52w volume_sma_20 volume_ratio obv obv_sma_20 plus_di_14 minus_di_14 adx_14 pct_from_high_20d pct_from_low_52w".split()
}


def _roll(agg: str, col: str, n: int, least: int | None = None) -> str:
    frame = f"OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) {frame} >= {least or n} THEN {agg}({col}) {frame} END"


INDICATOR_CTE = f"""
i1 AS (SELECT *, lag(close) OVER w AS prev, lag(high) OVER w AS ph, lag(low) OVER w AS pl, lag(close, 20) OVER w AS c20, row_number() OVER w AS bar, CAST(volume AS DOUBLE) AS v FROM bars_daily WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
i2 AS (SELECT *, greatest(coalesce(close - prev, 0), 0) AS gain, greatest(coalesce(prev - close, 0), 0) AS loss, greatest(high - low, abs(high - prev), abs(low - prev)) AS tr, close / prev - 1 AS ret, ln(high / low) ** 2 AS range2,
        CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END AS pdm, coalesce(sign(close - prev), 0) * v AS sv FROM i1),
i3 AS (SELECT *, CASE WHEN pl - low > pdm AND pl - low > 0 THEN pl - low ELSE 0 END AS mdm FROM i2),
i4 AS (SELECT *, {_roll("avg", "close", 20)} AS sma_20, {_roll("avg", "close", 50)} AS sma_50, {_roll("avg", "close", 200)} AS sma_200, {_roll("avg", "gain", 14)} AS g14, {_roll("avg", "loss", 14)} AS l14, {_roll("max", "high", 14)} AS hh, {_roll("min", "low", 14)} AS ll,
        (close / c20 - 1) * 100 AS roc_20, {_roll("avg", "tr", 14)} AS atr_14, {_roll("stddev_samp", "close", 20)} AS sd, {_roll("stddev_samp", "ret", 20)} * sqrt(252) * 100 AS realized_vol_20, sqrt({_roll("avg", "range2", 20)} / (4 * ln(2))) * sqrt(252) * 100 AS parkinson_vol_20,
        {_roll("max", "high", 20)} AS high_20d, {_roll("min", "low", 20)} AS low_20d, {_roll("max", "high", 252, 100)} AS high_52w, {_roll("min", "low", 252, 100)} AS low_52w, {_roll("avg", "v", 20)} AS volume_sma_20,
        sum(sv) OVER (PARTITION BY ticker ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS obv, {_roll("sum", "pdm", 14)} / nullif({_roll("sum", "tr", 14)}, 0) * 100 AS plus_di_14, {_roll("sum", "mdm", 14)} / nullif({_roll("sum", "tr", 14)}, 0) * 100 AS minus_di_14 FROM i3),
i5 AS (SELECT *, (close - ll) / nullif(hh - ll, 0) * 100 AS stoch_k, abs(plus_di_14 - minus_di_14) / nullif(plus_di_14 + minus_di_14, 0) * 100 AS dx FROM i4),
er AS (
  SELECT ticker, bar, close AS e12, close AS e26, CAST(NULL AS DOUBLE) AS sig FROM i1 WHERE bar = 1
  UNION ALL
  SELECT x.ticker, x.bar, n12, n26, CASE WHEN x.bar < 26 THEN NULL WHEN x.sig IS NULL THEN n12 - n26 ELSE 0.2 * (n12 - n26) + 0.8 * x.sig END
  FROM (SELECT i1.ticker, i1.bar, close * 2 / 13 + er.e12 * 11 / 13 AS n12, close * 2 / 27 + er.e26 * 25 / 27 AS n26, er.sig FROM er JOIN i1 ON i1.ticker = er.ticker AND i1.bar = er.bar + 1) x),
indicators AS (
  SELECT i5.*, {_roll("avg", "stoch_k", 3)} AS stoch_d, {_roll("avg", "dx", 14)} AS adx_14, {_roll("avg", "obv", 20)} AS obv_sma_20, v / nullif(volume_sma_20, 0) AS volume_ratio, (close - high_20d) / high_20d * 100 AS pct_from_high_20d,
         (close - low_52w) / low_52w * 100 AS pct_from_low_52w, sma_20 AS bb_middle, sma_20 + 2 * sd AS bb_upper, sma_20 - 2 * sd AS bb_lower, 4 * sd AS bb_width, CASE WHEN l14 > 0 THEN 100 - 100 / (1 + g14 / l14) WHEN g14 > 0 THEN 100 END AS rsi_14
  FROM i5),
full_indicators AS (
  SELECT i.*, CASE WHEN i.bar >= 12 THEN e12 END AS ema_12, CASE WHEN i.bar >= 26 THEN e26 END AS ema_26, CASE WHEN i.bar >= 26 THEN e12 - e26 END AS macd, CASE WHEN i.bar >= 34 THEN sig END AS macd_signal, CASE WHEN i.bar >= 34 THEN e12 - e26 - sig END AS macd_histogram
  FROM indicators i JOIN er ON er.ticker = i.ticker AND er.bar = i.bar WHERE sma_20 IS NOT NULL)"""


@register("technical_indicators", f"WITH RECURSIVE {adapters.oracle('bars_daily')},{INDICATOR_CTE} SELECT {sql_rounded(INDICATORS)} FROM full_indicators")
def technical_indicators_query(spark, sf_dir):
    return select_rounded(technical_indicators(adapters.load(spark, sf_dir, "bars_daily")), INDICATORS)


# Regimes


def market_regimes(ind: DataFrame) -> DataFrame:
    """Trend, volatility and phase of each bar with a recommended strategy and the length of the current regime. ind has the bars'
    spans; positions are counted anew, since bars without a full month behind them are not in it."""
    needed = "ticker trade_date bar span close sma_20 sma_50 sma_200 plus_di_14 minus_di_14 adx_14 macd macd_signal atr_14 realized_vol_20 bb_width volume_ratio rsi_14 obv obv_sma_20 high_52w high_20d low_52w low_20d".split()
    ind = running_sums(stored(ind.select(*needed)), "ticker", "bar", {"pos": F.lit(1)}).withColumn("pos", F.col("pos").cast("long")).drop("span")
    measures = ["atr_14", "realized_vol_20", "bb_width"]
    ind = trailing_below(ind, "ticker", "pos", {f"below_{m}": m for m in measures}, YEAR + 1, SPAN)
    c, s20, s50, s200 = (F.col(x) for x in ("close", "sma_20", "sma_50", "sma_200"))
    off, di, adx, macd = (c - s200) / s200 * 100, F.col("plus_di_14") - F.col("minus_di_14"), F.col("adx_14"), F.col("macd") - F.col("macd_signal")
    zero = F.lit(0.0)
    align = F.when((s20 > s50) & (s50 > s200), 40.0).when((s20 < s50) & (s50 < s200), -40.0)
    place = F.when(off > 2, 20.0).when(off < -2, -20.0).otherwise(5 * off)
    force = F.when(adx > 25, F.when(di > 5, 30.0).when(di < -5, -30.0).otherwise(3 * di)).when(adx < 20, di / 2).when(adx.isNotNull(), 2 * di)
    score = F.coalesce(align, zero) + F.coalesce(place, zero) + F.coalesce(force, zero) + F.when(macd > 0, 10.0).when(macd <= 0, -10.0).otherwise(0.0)
    share = lambda m: F.when((F.col("pos") > YEAR) & F.col(m).isNotNull(), F.col(f"below_{m}") / (YEAR + 1) * 100).otherwise(50.0)
    df = ind.withColumns({"trend_score": F.round(score, 6), "vol_percentile": F.round(sum((share(m) for m in measures[1:]), share(measures[0])) / 3, 6)})
    up, down = F.coalesce(s20 > s50, F.lit(False)), F.coalesce(s20 < s50, F.lit(False))
    flat = ~up & ~down
    vr, rsi = F.coalesce(F.col("volume_ratio"), F.lit(1.0)), F.coalesce(F.col("rsi_14"), F.lit(50.0))
    rising = F.when((F.col("pos") > 20) & F.col("obv_sma_20").isNotNull(), F.col("obv") > F.col("obv_sma_20"))
    points = lambda *terms: sum((F.when(cond, n).otherwise(0) for cond, n in terms), F.lit(0))
    gain, drop = F.coalesce(macd > 0, F.lit(False)), F.coalesce(macd < 0, F.lit(False))
    in_, out_ = F.coalesce(rising, F.lit(False)), F.coalesce(~rising, F.lit(False))
    df = df.withColumns({
        "accumulation": points((flat, 30), (vr > 1.2, 25), (rsi < 40, 25), (in_, 20)), "markup": points((up, 30), (vr > 1.2, 25), (gain, 25), (in_, 20)),
        "distribution": points((flat | (up & (rsi > 60)), 30), (vr > 1.5, 25), (rsi > 60, 25), (out_, 20)), "markdown": points((down, 30), (vr <= 1.2, 25), (drop, 25), (out_, 20)),
    })
    phases = ["accumulation", "markup", "distribution", "markdown"]
    top = F.greatest(*phases)
    phase = F.when(F.col(phases[0]) == top, phases[0])
    for p in phases[1:]:
        phase = phase.when(F.col(p) == top, p)
    t, v, ph = F.col("trend_regime"), F.col("volatility_regime"), F.col("market_phase")
    resist, support = F.coalesce("high_52w", "high_20d"), F.coalesce("low_52w", "low_20d")
    df = df.withColumns({
        "trend_regime": F.when(F.col("trend_score") > 30, "uptrend").when(F.col("trend_score") < -30, "downtrend").otherwise("ranging"), "trend_strength": F.least(F.greatest((F.col("trend_score") / 100 + 1) * 50, F.lit(0.0)), F.lit(100.0)),
        "volatility_regime": F.when(F.col("vol_percentile") > 70, "high").when(F.col("vol_percentile") < 30, "low").otherwise("normal"), "market_phase": phase, "phase_confidence": top, "support": support, "resistance": resist,
        "support_strength": F.greatest(100 - F.abs((c - support) / c) * 200, F.lit(0.0)), "resistance_strength": F.greatest(100 - F.abs((resist - c) / c) * 200, F.lit(0.0)),
    }).where(F.col("close").isNotNull() & F.col("rsi_14").isNotNull()).withColumn(
        "strategy",
        F.when((t == "ranging") & (v == "low"), "iron_condor").when((t == "uptrend") & ph.isin("accumulation", "markup"), F.when(v == "low", "bull_call_spread").otherwise("long_call"))
        .when((t == "downtrend") & ph.isin("distribution", "markdown"), F.when(v == "low", "bear_put_spread").otherwise("long_put")).when(v == "high", F.when(t == "ranging", "short_straddle").otherwise("long_straddle"))
        .when(ph == "accumulation", "bull_call_spread").when(ph == "distribution", "bear_put_spread").otherwise("neutral_strategy"),
    )
    df = stored(df.withColumn("span", span_of("pos", SPAN)).select("ticker", "trade_date", "close", "pos", "span", *[c for c in REGIMES if c not in ("ticker", "trade_date", "days_in_regime")]))
    return run_lengths(df, "ticker", "pos", ["trend_regime", "volatility_regime", "market_phase"], "days_in_regime")


REGIMES = {"ticker": None, "trade_date": None, "trend_score": 4, "trend_strength": 4, "trend_regime": None, "vol_percentile": 4, "volatility_regime": None, "market_phase": None, "phase_confidence": None, "support": 4, "resistance": 4, "support_strength": 4, "resistance_strength": 4, "strategy": None, "days_in_regime": None}


def _below(c: str) -> str:
    return f"CASE WHEN pos > 252 AND {c} IS NOT NULL THEN len(list_filter(list({c}) OVER b, lambda x: x < {c})) / 253 * 100 ELSE 50 END"


REGIME_SQL = f"""
WITH RECURSIVE {adapters.oracle("bars_daily")},{INDICATOR_CTE},
p AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS pos, plus_di_14 - minus_di_14 AS di, macd - macd_signal AS md, (close - sma_200) / sma_200 * 100 AS off FROM full_indicators),
q AS (SELECT *, round(CASE WHEN sma_20 > sma_50 AND sma_50 > sma_200 THEN 40 WHEN sma_20 < sma_50 AND sma_50 < sma_200 THEN -40 ELSE 0 END + coalesce(CASE WHEN off > 2 THEN 20 WHEN off < -2 THEN -20 ELSE 5 * off END, 0)
        + coalesce(CASE WHEN adx_14 > 25 THEN CASE WHEN di > 5 THEN 30 WHEN di < -5 THEN -30 ELSE 3 * di END WHEN adx_14 < 20 THEN di / 2 WHEN adx_14 IS NOT NULL THEN 2 * di END, 0) + CASE WHEN md > 0 THEN 10 WHEN md <= 0 THEN -10 ELSE 0 END, 6) AS trend_score,
        round(({_below("atr_14")} + {_below("realized_vol_20")} + {_below("bb_width")}) / 3, 6) AS vol_percentile, coalesce(sma_20 > sma_50, false) AS up, coalesce(sma_20 < sma_50, false) AS down, coalesce(volume_ratio, 1) AS vr, coalesce(rsi_14, 50) AS rsi,
        CASE WHEN pos > 20 AND obv_sma_20 IS NOT NULL THEN obv > obv_sma_20 END AS rising FROM p WINDOW b AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 252 PRECEDING AND CURRENT ROW)),
s AS (SELECT *, if(NOT up AND NOT down, 30, 0) + if(vr > 1.2, 25, 0) + if(rsi < 40, 25, 0) + if(coalesce(rising, false), 20, 0) AS f1, if(up, 30, 0) + if(vr > 1.2, 25, 0) + if(coalesce(md > 0, false), 25, 0) + if(coalesce(rising, false), 20, 0) AS f2,
        if(NOT up AND NOT down OR up AND rsi > 60, 30, 0) + if(vr > 1.5, 25, 0) + if(rsi > 60, 25, 0) + if(coalesce(NOT rising, false), 20, 0) AS f3, if(down, 30, 0) + if(vr <= 1.2, 25, 0) + if(coalesce(md < 0, false), 25, 0) + if(coalesce(NOT rising, false), 20, 0) AS f4,
        coalesce(high_52w, high_20d) AS resistance, coalesce(low_52w, low_20d) AS support FROM q),
t AS (SELECT *, CASE WHEN trend_score > 30 THEN 'uptrend' WHEN trend_score < -30 THEN 'downtrend' ELSE 'ranging' END AS trend_regime, least(greatest((trend_score / 100 + 1) * 50, 0), 100) AS trend_strength,
        CASE WHEN vol_percentile > 70 THEN 'high' WHEN vol_percentile < 30 THEN 'low' ELSE 'normal' END AS volatility_regime, greatest(f1, f2, f3, f4) AS phase_confidence,
        CASE greatest(f1, f2, f3, f4) WHEN f1 THEN 'accumulation' WHEN f2 THEN 'markup' WHEN f3 THEN 'distribution' ELSE 'markdown' END AS market_phase, greatest(100 - abs((close - support) / close) * 200, 0) AS support_strength,
        greatest(100 - abs((resistance - close) / close) * 200, 0) AS resistance_strength FROM s WHERE close IS NOT NULL AND rsi_14 IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) - row_number() OVER (PARTITION BY ticker, trend_regime, volatility_regime, market_phase ORDER BY trade_date) AS isle FROM t),
z AS (SELECT *, row_number() OVER (PARTITION BY ticker, trend_regime, volatility_regime, market_phase, isle ORDER BY trade_date) AS days_in_regime,
        CASE WHEN trend_regime = 'ranging' AND volatility_regime = 'low' THEN 'iron_condor' WHEN trend_regime = 'uptrend' AND market_phase IN ('accumulation', 'markup') THEN if(volatility_regime = 'low', 'bull_call_spread', 'long_call')
             WHEN trend_regime = 'downtrend' AND market_phase IN ('distribution', 'markdown') THEN if(volatility_regime = 'low', 'bear_put_spread', 'long_put') WHEN volatility_regime = 'high' THEN if(trend_regime = 'ranging', 'short_straddle', 'long_straddle')
             WHEN market_phase = 'accumulation' THEN 'bull_call_spread' WHEN market_phase = 'distribution' THEN 'bear_put_spread' ELSE 'neutral_strategy' END AS strategy FROM g)
SELECT {sql_rounded(REGIMES)} FROM z"""


@register("market_regimes", REGIME_SQL)
def market_regimes_query(spark, sf_dir):
    return select_rounded(market_regimes(technical_indicators(adapters.load(spark, sf_dir, "bars_daily"))), REGIMES)


DISTRIBUTION = {"trend_regime": None, "volatility_regime": None, "market_phase": None, "n_rows": None, "n_tickers": None, "share_pct": 4}


@register(
    "regime_distribution",
    f"WITH r AS ({REGIME_SQL}), d AS (SELECT trend_regime, volatility_regime, market_phase, count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct FROM r GROUP BY 1, 2, 3) SELECT {sql_rounded(DISTRIBUTION)} FROM d",
)
def regime_distribution(spark, sf_dir):
    """How often each combination of regimes occurs; a few dozen rows at most."""
    rows = market_regimes_query(spark, sf_dir).groupBy("trend_regime", "volatility_regime", "market_phase").agg(F.count("*").alias("n_rows"), F.count_distinct("ticker").alias("n_tickers"))
    return select_rounded(rows.withColumn("share_pct", F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy())), DISTRIBUTION)


@register(
    "regime_signals",
    f"""
WITH r AS ({REGIME_SQL}),
x AS (SELECT *, lag(trend_regime) OVER (PARTITION BY ticker ORDER BY trade_date) AS before FROM r)
SELECT ticker, trade_date, strategy, CASE WHEN before IS NOT NULL AND before <> trend_regime THEN 'yes' ELSE 'no' END AS regime_change,
       '{{"trend":"' || trend_regime || '","volatility":"' || volatility_regime || '","phase":"' || market_phase || '","confidence":' || phase_confidence || ',"days":' || days_in_regime || '}}' AS rationale
FROM x QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) = 1""",
)
def regime_signals(spark, sf_dir):
    """The newest row of each ticker with its rationale as JSON."""
    w = series("ticker", "trade_date")
    rows = market_regimes_query(spark, sf_dir).withColumn("regime_change", F.when(F.lag("trend_regime").over(w) != F.col("trend_regime"), "yes").otherwise("no"))
    why = F.to_json(F.struct(F.col("trend_regime").alias("trend"), F.col("volatility_regime").alias("volatility"), F.col("market_phase").alias("phase"), F.col("phase_confidence").alias("confidence"), F.col("days_in_regime").alias("days")))
    return latest_by(rows, ["ticker"], [F.desc("trade_date")]).select("ticker", "trade_date", "strategy", "regime_change", why.alias("rationale"))
