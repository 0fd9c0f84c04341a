"""Daily checks and profiles: the day's open interest, coverage against thresholds, forward returns by indicator bucket, results
of listed tickers and by side, and symbols of monthly contracts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.dates import third_friday
from tidemark.functions.numbers import safe_div, sum_if
from tidemark.operators.series import series
from tidemark.plans.gold_chain import CHAIN, chain_of, select_rounded, sql_rounded
from tidemark.plans.registry import ORACLES, QUERIES, register
from tidemark.sources import adapters

DAILY = dict.fromkeys(["ticker", "trade_date", "atm_strike", "call_oi", "put_oi", "call_volume", "put_volume", "oi_change"]) | {"midpoint": 2, "put_call_oi": 6, "put_call_volume": 6}


@register(
    "daily_open_interest",
    f"""
WITH {CHAIN},
d AS (SELECT ticker, trade_date, (min(strike) + max(strike)) / 2 AS midpoint, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_oi, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_oi,
        CAST(coalesce(sum(volume) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_volume, CAST(coalesce(sum(volume) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_volume FROM option_chain GROUP BY 1, 2),
a AS (SELECT c.ticker, c.trade_date, arg_min(strike, row(abs(strike - midpoint), strike)) AS atm_strike FROM option_chain c JOIN d USING (ticker, trade_date) GROUP BY 1, 2),
r AS (SELECT d.*, atm_strike, call_oi + put_oi - lag(call_oi + put_oi) OVER (PARTITION BY d.ticker ORDER BY d.trade_date) AS oi_change, put_oi / nullif(call_oi, 0) AS put_call_oi, put_volume / nullif(call_volume, 0) AS put_call_volume FROM d JOIN a USING (ticker, trade_date))
SELECT {sql_rounded(DAILY)} FROM r""",
)
def daily_open_interest(spark, sf_dir):
    """Per day calls and puts, the change, and the strike nearest to the middle of the strikes in place of a missing spot."""
    call = F.col("option_type") == "Call"
    w = Window.partitionBy("ticker", "trade_date")
    chain = chain_of(spark, sf_dir).withColumn("midpoint", (F.min("strike").over(w) + F.max("strike").over(w)) / 2)
    day = chain.groupBy("ticker", "trade_date").agg(
        F.max("midpoint").alias("midpoint"), F.min(F.struct(F.abs(F.col("strike") - F.col("midpoint")).alias("gap"), "strike"))["strike"].alias("atm_strike"), sum_if(call, F.col("open_interest")).alias("call_oi"), sum_if(~call, F.col("open_interest")).alias("put_oi"),
        sum_if(call, F.col("volume")).alias("call_volume"), sum_if(~call, F.col("volume")).alias("put_volume"),
    )
    whole = F.col("call_oi") + F.col("put_oi")
    return select_rounded(day.withColumns({"oi_change": whole - F.lag(whole).over(series("ticker", "trade_date")), "put_call_oi": safe_div(F.col("put_oi"), F.col("call_oi")), "put_call_volume": safe_div(F.col("put_volume"), F.col("call_volume"))}), DAILY)


# Least share of rows with quotes, with valid Greeks and with interest, and what each adds to the score.
COVERAGE = {"quotes": (0.5, 40), "greeks": (0.6, 30), "interest": (0.9, 30)}
QUALITY = {"trade_date": None, "n_rows": None, "quotes_pct": 4, "greeks_pct": 4, "interest_pct": 4, "score": 4, "status": None}


@register(
    "coverage_checks",
    f"""
WITH {CHAIN},
c AS (SELECT trade_date, count(*) AS n_rows, count(bid) / count(*) AS quotes, avg(CAST(greeks_valid AS INTEGER)) AS greeks, avg(if(open_interest > 0, 1, 0)) AS interest FROM option_chain GROUP BY 1),
s AS (SELECT *, quotes * 100 AS quotes_pct, greeks * 100 AS greeks_pct, interest * 100 AS interest_pct, {" + ".join(f"least({k} / {v[0]}, 1.0) * {v[1]}" for k, v in COVERAGE.items())} AS score,
        CASE WHEN {" AND ".join(f"{k} >= {v[0]}" for k, v in COVERAGE.items())} THEN 'pass' WHEN {" OR ".join(f"{k} < {v[0] / 2}" for k, v in COVERAGE.items())} THEN 'fail' ELSE 'warn' END AS status FROM c)
SELECT {sql_rounded(QUALITY)} FROM s""",
)
def coverage_checks(spark, sf_dir):
    """Coverage of each day's chain against thresholds, with a weighted score."""
    day = chain_of(spark, sf_dir).groupBy("trade_date").agg(F.count("*").alias("n_rows"), (F.count("bid") / F.count("*")).alias("quotes"), F.avg(F.col("greeks_valid").cast("int")).alias("greeks"), F.avg((F.col("open_interest") > 0).cast("int")).alias("interest"))
    every, none, score = F.lit(True), F.lit(False), F.lit(0.0)
    for name, (least, points) in COVERAGE.items():
        every, none, score = every & (F.col(name) >= least), none | (F.col(name) < least / 2), score + F.least(F.col(name) / least, F.lit(1.0)) * points
    out = day.withColumns({f"{c}_pct": F.col(c) * 100 for c in COVERAGE} | {"score": score, "status": F.when(every, "pass").when(none, "fail").otherwise("warn")})
    return select_rounded(out, QUALITY)


BARS = {"trade_date": None, "n_bars": None, "n_valid": None, "n_missing_volume": None, "valid_pct": 4}


@register(
    "bar_validity",
    f"WITH {adapters.oracle('bars_daily')}, v AS (SELECT trade_date, count(*) AS n_bars, count(*) FILTER (high >= low AND high >= open AND high >= close AND low <= open AND low <= close AND low > 0) AS n_valid, count(*) FILTER (volume IS NULL OR volume = 0) AS n_missing_volume FROM bars_daily GROUP BY 1), p AS (SELECT *, n_valid * 100.0 / n_bars AS valid_pct FROM v) SELECT {sql_rounded(BARS)} FROM p",
)
def bar_validity(spark, sf_dir):
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    good = (h >= l) & (h >= o) & (h >= c) & (l <= o) & (l <= c) & (l > 0)
    day = adapters.load(spark, sf_dir, "bars_daily").groupBy("trade_date").agg(F.count("*").alias("n_bars"), F.count(F.when(good, 1)).alias("n_valid"), F.count(F.when(F.col("volume").isNull() | (F.col("volume") == 0), 1)).alias("n_missing_volume"))
    return select_rounded(day.withColumn("valid_pct", F.col("n_valid") * 100.0 / F.col("n_bars")), BARS)


PROFILE = {"rsi_bucket": None, "n": None, "mean_pct": 4, "std_pct": 4, "min_pct": 4, "max_pct": 4, "up_share": 4}


@register(
    "returns_by_rsi",
    f"""
WITH {adapters.oracle("bars_daily")},
i AS ({ORACLES["technical_indicators"]}),
b AS (SELECT ticker, trade_date, (lead(close, 5) OVER w / close - 1) * 100 AS fwd FROM bars_daily WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
j AS (SELECT CAST(least(floor(rsi_14 / 20), 4) AS BIGINT) AS rsi_bucket, fwd FROM b JOIN i USING (ticker, trade_date) WHERE fwd IS NOT NULL AND rsi_14 IS NOT NULL),
p AS (SELECT rsi_bucket, count(*) AS n, avg(fwd) AS mean_pct, CASE WHEN count(*) > 1 THEN stddev_samp(fwd) END AS std_pct, min(fwd) AS min_pct, max(fwd) AS max_pct, avg(if(fwd > 0, 1, 0)) AS up_share FROM j GROUP BY 1)
SELECT {sql_rounded(PROFILE)} FROM p""",
)
def returns_by_rsi(spark, sf_dir):
    """What followed: bars joined with their indicators, the next five sessions' returns described by bucket."""
    w = series("ticker", "trade_date")
    bars = adapters.load(spark, sf_dir, "bars_daily").withColumn("fwd", (F.lead("close", 5).over(w) / F.col("close") - 1) * 100).select("ticker", "trade_date", "fwd")
    both = bars.join(QUERIES["technical_indicators"](spark, sf_dir).select("ticker", "trade_date", "rsi_14"), ["ticker", "trade_date"]).where("fwd is not null and rsi_14 is not null")
    x = F.col("fwd")
    out = both.groupBy(F.least(F.floor(F.col("rsi_14") / 20), F.lit(4)).cast("long").alias("rsi_bucket")).agg(F.count("*").alias("n"), F.avg(x).alias("mean_pct"), F.stddev_samp(x).alias("std_pct"), F.min(x).alias("min_pct"), F.max(x).alias("max_pct"), F.avg((x > 0).cast("int")).alias("up_share"))
    return select_rounded(out, PROFILE)


LISTED = ["click", "view", "purchase"]
SIDES = {"ticker": None, "side": None, "n_trades": None, "win_rate": 4, "mean_pct": 4, "median_pct": 4, "total_eur": 2, "roi_pct": 4, "sharpe": 4, "go": None}


@register(
    "listed_backtest",
    f"""
WITH t AS (SELECT * FROM ({ORACLES["event_trades"]}) WHERE pnl_pct IS NOT NULL AND ticker IN ('click', 'view', 'purchase')),
g AS (SELECT coalesce(ticker, 'all') AS ticker, coalesce(side, 'both') AS side, count(*) AS n_trades, avg(if(pnl_eur > 0, 1, 0)) * 100 AS win_rate, avg(pnl_pct) AS mean_pct, median(pnl_pct) AS median_pct, sum(pnl_eur) AS total_eur, sum(pnl_eur) / 20000.0 * 100 AS roi_pct,
        CASE WHEN count(*) > 1 THEN avg(pnl_pct) / nullif(stddev_samp(pnl_pct), 0) * sqrt(count(*) * 12.0) END AS sharpe FROM t GROUP BY ROLLUP (ticker, side) HAVING count(*) > 0),
r AS (SELECT *, win_rate >= 55 AND coalesce(sharpe, 0) > 0 AND total_eur > 0 AS go FROM g)
SELECT {sql_rounded(SIDES)} FROM r""",
)
def listed_backtest(spark, sf_dir):
    """Results of an explicit list of tickers, by ticker and side, by ticker and in all, and whether they are good enough to go
    on. A month of trades stands for a twelfth of a year."""
    done = QUERIES["event_trades"](spark, sf_dir).where("pnl_pct is not null").where(F.col("ticker").isin(LISTED))
    p = F.col("pnl_pct")
    out = done.rollup("ticker", "side").agg(
        F.count("*").alias("n_trades"), (F.avg((F.col("pnl_eur") > 0).cast("double")) * 100).alias("win_rate"), F.avg(p).alias("mean_pct"), F.median(p).alias("median_pct"), F.sum("pnl_eur").alias("total_eur"), F.stddev_samp(p).alias("std"),
    )
    out = out.withColumns({"ticker": F.coalesce("ticker", F.lit("all")), "side": F.coalesce("side", F.lit("both")), "roi_pct": F.col("total_eur") / 20000.0 * 100, "sharpe": safe_div(F.col("mean_pct"), F.col("std")) * F.sqrt(F.col("n_trades") * 12.0)})
    return select_rounded(out.withColumn("go", (F.col("win_rate") >= 55) & (F.coalesce("sharpe", F.lit(0.0)) > 0) & (F.col("total_eur") > 0)), SIDES)


@register(
    "monthly_contracts",
    f"""
WITH {CHAIN},
s AS (SELECT ticker, strike, expiry_date, upper(substr(ticker, 1, 2)) || CASE WHEN CAST(strike AS BIGINT) % 4 = 0 THEN CAST(CAST(strike AS BIGINT) % 9 AS VARCHAR) ELSE '' END AS symbol FROM option_chain)
SELECT symbol, count(*) AS n, count(DISTINCT expiry_date) AS n_expiries, min(expiry_date) AS first_expiry FROM s WHERE regexp_full_match(symbol, '[A-Z]{{1,3}}') GROUP BY symbol""",
)
def monthly_contracts(spark, sf_dir):
    """Symbols of one to three letters are those of monthly contracts; weekly ones carry a digit."""
    k = F.col("strike").cast("long")
    symbol = F.concat(F.upper(F.substring("ticker", 1, 2)), F.when(k % 4 == 0, (k % 9).cast("string")).otherwise(""))
    rows = chain_of(spark, sf_dir).withColumn("symbol", symbol).where(F.col("symbol").rlike("^[A-Z]{1,3}$") & (F.col("expiry_date") == third_friday(F.col("expiry_date"))))
    return rows.groupBy("symbol").agg(F.count("*").alias("n"), F.count_distinct("expiry_date").alias("n_expiries"), F.min("expiry_date").alias("first_expiry"))
