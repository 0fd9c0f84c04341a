"""Open-interest flow, put/call sentiment, volatility skew, term structure and surface, and the daily summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import dow0, week_friday
from tidemark.functions.numbers import safe_div, sum_if, when_call
from tidemark.operators.rows import latest_by
from tidemark.plans.gold_gamma import LAST_SESSIONS, r, steps
from tidemark.plans.registry import register
from tidemark.sources import adapters

CHAIN = adapters.oracle("option_chain")


def is_call() -> Column:
    return F.col("option_type") == "Call"


def is_put() -> Column:
    return F.col("option_type") == "Put"


def chain_of(spark, sf_dir) -> DataFrame:
    return adapters.load(spark, sf_dir, "option_chain")


def select_rounded(df: DataFrame, columns: dict[str, int | None]) -> DataFrame:
    """Rounded a little off the ties, which the two engines break differently."""
    return df.select(*[c if n is None else r(F.col(c) + 3 * 10.0 ** -(n + 3), n).alias(c) for c, n in columns.items()])


def sql_rounded(columns: dict[str, int | None]) -> str:
    return ", ".join(c if n is None else f"round({c} + 3e-{n + 3}, {n}) AS {c}" for c, n in columns.items())


def names(text: str, **rounded: int) -> dict[str, int | None]:
    return {c: rounded.get(c) for c in text.split()}


# Open-interest flow


def open_interest_flow(chain: DataFrame, significant: int = 100) -> DataFrame:
    """Change of each contract's open interest against its previous week that has data."""
    key = ["ticker", "option_type", "strike", "expiry_date"]
    some = chain.where((F.col("open_interest") > 0) & dow0(F.col("trade_date")).isin(*LAST_SESSIONS)).withColumn("week_ending", week_friday(F.col("trade_date")))
    w = Window.partitionBy(*key).orderBy("week_ending")
    rows = latest_by(some, ["week_ending", *key], [F.desc("trade_date")]).withColumns({"previous_week_oi": F.lag("open_interest").over(w), "previous_week_price": F.lag("last_price").over(w), "previous_week_iv": F.lag("implied_volatility").over(w)})
    change, m, days = F.col("oi_change"), F.col("side_moneyness"), F.col("days_to_expiry")
    return (
        rows.where(F.col("previous_week_oi").isNotNull() & (F.col("open_interest") >= significant))
        .withColumns({"oi_change": F.col("open_interest") - F.col("previous_week_oi"), "side_moneyness": when_call(F.col("option_type"), F.col("underlying_price") / F.col("strike"), F.col("strike") / F.col("underlying_price"))})
        .withColumns({
            "oi_change_pct": safe_div(change, F.col("previous_week_oi")) * 100,
            "notional": F.col("open_interest") * F.col("last_price") * 100,
            "notional_flow": change * F.col("last_price") * 100,
            "flow_type": F.when(change > 100, "Heavy Accumulation").when(change > 50, "Accumulation").when(change > 0, "Mild Buildup").when(change == 0, "Flat").when(change > -50, "Mild Liquidation").when(change > -100, "Liquidation").otherwise("Heavy Liquidation"),
            "change_magnitude": F.when(F.abs(change) >= 100, "Large").when(F.abs(change) >= 50, "Medium").when(F.abs(change) >= 10, "Small").otherwise("Minimal"),
            "moneyness_category": F.when(m.between(0.95, 1.05), "ATM").when(m > 1.05, "ITM").otherwise("OTM"),
            "expiry_category": steps(days, [(7, "Weekly"), (30, "Near-term"), (90, "Medium-term")], "Long-term"),
            "delta_weighted_oi_change": change * F.coalesce("delta", F.lit(0.0)),
        })
    )


FLOW = names(
    "week_ending trade_date ticker option_type strike expiry_date open_interest previous_week_oi oi_change oi_change_pct notional notional_flow previous_week_price previous_week_iv flow_type change_magnitude moneyness_category expiry_category delta_weighted_oi_change",
    oi_change_pct=4, notional=2, notional_flow=2, previous_week_iv=6, delta_weighted_oi_change=3,
)


@register(
    "open_interest_flow",
    f"""
WITH {CHAIN},
w AS (SELECT *, trade_date + CAST(5 - dayofweek(trade_date) AS INTEGER) AS week_ending FROM option_chain WHERE open_interest > 0 AND dayofweek(trade_date) IN (4, 5, 6)),
o AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY week_ending, ticker, option_type, strike, expiry_date ORDER BY trade_date DESC) = 1),
l AS (SELECT *, lag(open_interest) OVER k AS previous_week_oi, lag(last_price) OVER k AS previous_week_price, lag(implied_volatility) OVER k AS previous_week_iv,
             CASE option_type WHEN 'Call' THEN underlying_price / strike ELSE strike / underlying_price END AS m FROM o WINDOW k AS (PARTITION BY ticker, option_type, strike, expiry_date ORDER BY week_ending)),
c AS (SELECT *, open_interest - previous_week_oi AS oi_change FROM l WHERE previous_week_oi IS NOT NULL AND open_interest >= 100),
f AS (SELECT *, oi_change / previous_week_oi * 100 AS oi_change_pct, open_interest * last_price * 100 AS notional, oi_change * last_price * 100 AS notional_flow, oi_change * coalesce(delta, 0) AS delta_weighted_oi_change,
        CASE WHEN oi_change > 100 THEN 'Heavy Accumulation' WHEN oi_change > 50 THEN 'Accumulation' WHEN oi_change > 0 THEN 'Mild Buildup' WHEN oi_change = 0 THEN 'Flat' WHEN oi_change > -50 THEN 'Mild Liquidation' WHEN oi_change > -100 THEN 'Liquidation' ELSE 'Heavy Liquidation' END AS flow_type,
        CASE WHEN abs(oi_change) >= 100 THEN 'Large' WHEN abs(oi_change) >= 50 THEN 'Medium' WHEN abs(oi_change) >= 10 THEN 'Small' ELSE 'Minimal' END AS change_magnitude,
        CASE WHEN m BETWEEN 0.95 AND 1.05 THEN 'ATM' WHEN m > 1.05 THEN 'ITM' ELSE 'OTM' END AS moneyness_category,
        CASE WHEN days_to_expiry <= 7 THEN 'Weekly' WHEN days_to_expiry <= 30 THEN 'Near-term' WHEN days_to_expiry <= 90 THEN 'Medium-term' ELSE 'Long-term' END AS expiry_category FROM c)
SELECT {sql_rounded(FLOW)} FROM f""",
)
def open_interest_flow_query(spark, sf_dir):
    return select_rounded(open_interest_flow(chain_of(spark, sf_dir)), FLOW)


# Put/call metrics


def put_call_metrics(chain: DataFrame) -> DataFrame:
    """Put/call ratios by day, expiry band and moneyness, with the mean of the last five rows, where enough was traded."""
    spot, k, days = F.col("underlying_price"), F.col("strike"), F.col("days_to_expiry")
    own = when_call(F.col("option_type"), spot / k, k / spot)
    beyond = when_call(F.col("option_type"), spot > k * 1.05, k > spot * 1.05)
    rows = chain.where(F.col("greeks_valid") & (F.col("expiry_date") > F.col("trade_date"))).withColumns({
        "moneyness_category": F.when(own.between(0.95, 1.05), "ATM").when(beyond, "ITM").otherwise("OTM"),
        "expiry_category": steps(days, [(7, "Weekly"), (30, "Near-term"), (90, "Medium-term")], "Long-term"),
    })
    keys = ["trade_date", "ticker", "expiry_category", "moneyness_category"]

    def side(name, cond):
        when = lambda c: F.when(cond, c)
        return [
            F.sum(when(F.col("volume"))).alias(f"{name}_volume"), F.sum(when(F.col("open_interest"))).alias(f"{name}_open_interest"), F.sum(when(F.coalesce("volume", F.lit(0)) * F.col("last_price") * 100)).alias(f"{name}_notional"),
            F.sum(when(F.col("open_interest") * F.col("delta"))).alias(f"{name}_delta_oi"), F.avg(when(F.col("implied_volatility"))).alias(f"{name}_avg_iv"), F.count(when(F.col("volume") > 0)).alias(f"{name}_contracts"),
            F.avg(when(spot)).alias(f"{name}_spot"),
        ]

    zero = lambda c: F.coalesce(c, F.lit(0))
    out = rows.groupBy(*keys).agg(*side("put", is_put()), *side("call", is_call()))
    ratio = F.col("pc_ratio_volume")
    mean = F.avg(ratio).over(Window.partitionBy("ticker", "expiry_category", "moneyness_category").orderBy("trade_date").rowsBetween(-4, 0))
    out = out.withColumns({
        "pc_ratio_volume": F.when(F.col("call_volume") > 0, zero("put_volume") / F.col("call_volume")),
        "pc_ratio_oi": F.when(F.col("call_open_interest") > 0, zero("put_open_interest") / F.col("call_open_interest")),
        "pc_ratio_notional": F.when(F.col("call_notional") > 0, zero("put_notional") / F.col("call_notional")),
        "net_delta_exposure": zero("call_delta_oi") - zero("put_delta_oi"),
        "put_call_iv_skew": zero("put_avg_iv") - zero("call_avg_iv"),
        "total_volume": zero("put_volume") + zero("call_volume"),
        "total_open_interest": zero("put_open_interest") + zero("call_open_interest"),
        "underlying_price": (zero("put_spot") + zero("call_spot")) / (F.col("put_spot").isNotNull().cast("int") + F.col("call_spot").isNotNull().cast("int")),
    }).withColumns({
        "pc_ratio_volume_ma5": mean,
        "pc_ratio_deviation": ratio - mean,
        "sentiment_signal": F.when(ratio > 1.5, "Very Bearish").when(ratio > 1.2, "Bearish").when(ratio > 0.8, "Neutral").when(ratio > 0.5, "Bullish").when(ratio.isNotNull(), "Very Bullish").otherwise("No Signal"),
        "data_quality": F.when((F.col("total_volume") > 100) & (F.col("total_open_interest") > 500), "High").when((F.col("total_volume") > 50) & (F.col("total_open_interest") > 200), "Medium").otherwise("Low"),
    })
    return out.where(F.col("data_quality") != "Low")


PUT_CALL = names(
    "trade_date ticker expiry_category moneyness_category pc_ratio_volume pc_ratio_oi pc_ratio_notional pc_ratio_volume_ma5 pc_ratio_deviation put_volume put_open_interest put_notional put_avg_iv put_contracts call_volume call_open_interest call_notional call_avg_iv call_contracts net_delta_exposure put_call_iv_skew total_volume total_open_interest sentiment_signal data_quality underlying_price",
    pc_ratio_volume=6, pc_ratio_oi=6, pc_ratio_notional=6, pc_ratio_volume_ma5=6, pc_ratio_deviation=6, put_notional=2, put_avg_iv=6, call_notional=2, call_avg_iv=6, net_delta_exposure=3, put_call_iv_skew=6, underlying_price=4,
)
_SIDES = ", ".join(
    f"CAST(sum(volume) FILTER (option_type = '{t}') AS BIGINT) AS {n}_volume, CAST(sum(open_interest) FILTER (option_type = '{t}') AS BIGINT) AS {n}_open_interest, sum(volume * last_price * 100) FILTER (option_type = '{t}') AS {n}_notional,"
    f" sum(open_interest * delta) FILTER (option_type = '{t}') AS {n}_delta, avg(implied_volatility) FILTER (option_type = '{t}') AS {n}_avg_iv, count(*) FILTER (option_type = '{t}' AND volume > 0) AS {n}_contracts, avg(underlying_price) FILTER (option_type = '{t}') AS {n}_spot"
    for n, t in (("put", "Put"), ("call", "Call"))
)


@register(
    "put_call_metrics",
    f"""
WITH {CHAIN},
b AS (SELECT *, CASE option_type WHEN 'Call' THEN underlying_price / strike ELSE strike / underlying_price END AS own,
        CASE WHEN days_to_expiry <= 7 THEN 'Weekly' WHEN days_to_expiry <= 30 THEN 'Near-term' WHEN days_to_expiry <= 90 THEN 'Medium-term' ELSE 'Long-term' END AS expiry_category FROM option_chain WHERE greeks_valid AND expiry_date > trade_date),
m AS (SELECT *, CASE WHEN own BETWEEN 0.95 AND 1.05 THEN 'ATM' WHEN option_type = 'Call' AND underlying_price > strike * 1.05 OR option_type = 'Put' AND strike > underlying_price * 1.05 THEN 'ITM' ELSE 'OTM' END AS moneyness_category FROM b),
a AS (SELECT trade_date, ticker, expiry_category, moneyness_category, {_SIDES} FROM m GROUP BY trade_date, ticker, expiry_category, moneyness_category),
s AS (SELECT *, CASE WHEN call_volume > 0 THEN coalesce(put_volume, 0) / call_volume END AS pc_ratio_volume, CASE WHEN call_open_interest > 0 THEN coalesce(put_open_interest, 0) / call_open_interest END AS pc_ratio_oi,
        CASE WHEN call_notional > 0 THEN coalesce(put_notional, 0) / call_notional END AS pc_ratio_notional, coalesce(call_delta, 0) - coalesce(put_delta, 0) AS net_delta_exposure, coalesce(put_avg_iv, 0) - coalesce(call_avg_iv, 0) AS put_call_iv_skew,
        coalesce(put_volume, 0) + coalesce(call_volume, 0) AS total_volume, coalesce(put_open_interest, 0) + coalesce(call_open_interest, 0) AS total_open_interest, list_avg([put_spot, call_spot]) AS underlying_price FROM a),
t AS (SELECT *, avg(pc_ratio_volume) OVER (PARTITION BY ticker, expiry_category, moneyness_category ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS pc_ratio_volume_ma5 FROM s),
q AS (SELECT *, pc_ratio_volume - pc_ratio_volume_ma5 AS pc_ratio_deviation,
        CASE WHEN pc_ratio_volume > 1.5 THEN 'Very Bearish' WHEN pc_ratio_volume > 1.2 THEN 'Bearish' WHEN pc_ratio_volume > 0.8 THEN 'Neutral' WHEN pc_ratio_volume > 0.5 THEN 'Bullish' WHEN pc_ratio_volume IS NOT NULL THEN 'Very Bullish' ELSE 'No Signal' END AS sentiment_signal,
        CASE WHEN total_volume > 100 AND total_open_interest > 500 THEN 'High' WHEN total_volume > 50 AND total_open_interest > 200 THEN 'Medium' ELSE 'Low' END AS data_quality FROM t)
SELECT {sql_rounded(PUT_CALL)} FROM q WHERE data_quality <> 'Low'""",
)
def put_call_metrics_query(spark, sf_dir):
    return select_rounded(put_call_metrics(chain_of(spark, sf_dir)), PUT_CALL)


# Volatility skew

BUCKETS = {"atm": "ATM", "near_atm_call": "Near ATM Call", "otm_call": "OTM Call", "deep_otm_call": "Deep OTM Call", "near_atm_put": "Near ATM Put", "otm_put": "OTM Put", "deep_otm_put": "Deep OTM Put"}


def volatility_skew(chain: DataFrame) -> DataFrame:
    """Volatility by moneyness and delta bucket of each expiry, with risk reversal, butterfly and the slope across expiries."""
    k, spot, iv, d = F.col("strike"), F.col("underlying_price"), F.col("implied_volatility"), F.col("delta")
    bucket = (
        F.when(F.abs(safe_div(k - spot, spot)) < 0.01, "ATM").when(k < spot * 0.90, "Deep OTM Put").when(k < spot * 0.95, "OTM Put").when(k < spot * 0.99, "Near ATM Put")
        .when(k > spot * 1.10, "Deep OTM Call").when(k > spot * 1.05, "OTM Call").when(k > spot * 1.01, "Near ATM Call").otherwise("ATM")
    )
    size = F.when(is_call(), d).otherwise(-d)
    at_delta = F.when((size >= 0.45) & (size <= 0.55), 50).when((size >= 0.20) & (size < 0.45), 25).when((size >= 0.08) & (size < 0.20), 10)
    keys = ["ticker", "trade_date", "expiry_date", "days_to_expiry", "underlying_price"]
    rows = chain.where(F.col("greeks_valid") & (iv > 0) & (iv < 5)).withColumns({"bucket": bucket, "at_delta": at_delta})
    weigh = lambda w: safe_div(F.sum(iv * w), F.sum(w))
    per = rows.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("bucket") == b, iv)).alias(f"{n}_iv") for n, b in BUCKETS.items()],
        F.avg(F.when(F.col("at_delta") == 50, iv)).alias("delta_50_iv"),
        *[F.avg(F.when((F.col("at_delta") == n) & c, iv)).alias(f"{s}_{n}d_iv") for n in (25, 10) for s, c in (("call", is_call()), ("put", is_put()))],
        F.avg(iv).alias("avg_iv"), F.min(iv).alias("min_iv"), F.max(iv).alias("max_iv"), F.stddev_samp(iv).alias("iv_stddev"), weigh(F.col("open_interest")).alias("oi_weighted_iv"), weigh(F.col("volume")).alias("volume_weighted_iv"),
        weigh(F.abs("vega") * F.col("open_interest")).alias("vega_weighted_iv"), F.sum("open_interest").alias("total_oi"), F.count("*").alias("num_options"), F.count(F.when(is_call(), 1)).alias("num_calls"),
    )
    day = Window.partitionBy("ticker", "trade_date")
    days, atm = F.col("days_to_expiry"), F.col("atm_iv")
    per = per.withColumns({
        "risk_reversal_25d": F.col("call_25d_iv") - F.col("put_25d_iv"), "butterfly_25d": (F.col("call_25d_iv") + F.col("put_25d_iv")) / 2 - atm, "put_skew": F.col("otm_put_iv") - atm, "call_skew": F.col("otm_call_iv") - atm,
        "skew_asymmetry_pct": safe_div(F.col("otm_put_iv") - F.col("otm_call_iv"), atm) * 100, "near_term_iv": F.avg(F.when(days < 30, atm)).over(day), "mid_term_iv": F.avg(F.when(days.between(30, 90), atm)).over(day),
        "far_term_iv": F.avg(F.when(days > 90, atm)).over(day),
    })
    slope, skew, rr, fly = F.round(F.col("near_term_iv") - F.col("far_term_iv"), 9), F.round("put_skew", 9), F.round("risk_reversal_25d", 9), F.round("butterfly_25d", 9)
    return per.withColumns({
        "term_structure_slope": slope,
        "term_structure_shape": F.when(slope > 0, "Normal (Contango)").when(slope < 0, "Inverted (Backwardation)").otherwise("Flat"),
        "put_skew_classification": F.when(skew > 0.05, "Steep Put Skew").when(skew > 0.02, "Moderate Put Skew").when(skew < -0.02, "Negative Put Skew").otherwise("Flat"),
        "sentiment_from_rr": F.when(rr < -0.03, "Very Bearish").when(rr < -0.01, "Bearish").when(rr > 0.03, "Very Bullish").when(rr > 0.01, "Bullish").otherwise("Neutral"),
        "tail_risk_classification": F.when(fly > 0.03, "High Tail Risk Premium").when(fly > 0.01, "Moderate Tail Risk").otherwise("Low Tail Risk"),
        "expiry_bucket": steps(days, [(7, "Weekly"), (30, "Monthly"), (90, "Quarterly")], "LEAPS"),
    })


_SKEW_VALUES = [*[f"{n}_iv" for n in BUCKETS], "delta_50_iv", "call_25d_iv", "put_25d_iv", "call_10d_iv", "put_10d_iv", "avg_iv", "min_iv", "max_iv", "iv_stddev", "oi_weighted_iv", "volume_weighted_iv", "vega_weighted_iv"]
_SKEW_VALUES += ["risk_reversal_25d", "butterfly_25d", "put_skew", "call_skew", "skew_asymmetry_pct", "near_term_iv", "mid_term_iv", "far_term_iv", "term_structure_slope"]
SKEW = {"ticker": None, "trade_date": None, "expiry_date": None, "days_to_expiry": None, "underlying_price": None, **{c: 6 for c in _SKEW_VALUES}, **dict.fromkeys(["total_oi", "num_options", "num_calls", "term_structure_shape", "put_skew_classification", "sentiment_from_rr", "tail_risk_classification", "expiry_bucket"])}


@register(
    "volatility_skew",
    f"""
WITH {CHAIN},
b AS (SELECT *, CASE WHEN abs((strike - underlying_price) / underlying_price) < 0.01 THEN 'ATM' WHEN strike < underlying_price * 0.9 THEN 'Deep OTM Put' WHEN strike < underlying_price * 0.95 THEN 'OTM Put' WHEN strike < underlying_price * 0.99 THEN 'Near ATM Put'
        WHEN strike > underlying_price * 1.1 THEN 'Deep OTM Call' WHEN strike > underlying_price * 1.05 THEN 'OTM Call' WHEN strike > underlying_price * 1.01 THEN 'Near ATM Call' ELSE 'ATM' END AS bucket,
        CASE option_type WHEN 'Call' THEN delta ELSE -delta END AS ad FROM option_chain WHERE greeks_valid AND implied_volatility > 0 AND implied_volatility < 5),
a AS (SELECT ticker, trade_date, expiry_date, days_to_expiry, underlying_price, {", ".join(f"avg(implied_volatility) FILTER (bucket = '{b}') AS {n}_iv" for n, b in BUCKETS.items())},
        avg(implied_volatility) FILTER (ad BETWEEN 0.45 AND 0.55) AS delta_50_iv,
        {", ".join(f"avg(implied_volatility) FILTER (option_type = '{t}' AND ad >= {lo} AND ad < {hi}) AS {t.lower()}_{n}d_iv" for n, lo, hi in ((25, 0.2, 0.45), (10, 0.08, 0.2)) for t in ("Call", "Put"))},
        avg(implied_volatility) AS avg_iv, min(implied_volatility) AS min_iv, max(implied_volatility) AS max_iv, CASE WHEN count(*) > 1 THEN stddev_samp(implied_volatility) END AS iv_stddev,
        sum(implied_volatility * open_interest) / nullif(sum(open_interest), 0) AS oi_weighted_iv, sum(implied_volatility * volume) / nullif(sum(volume), 0) AS volume_weighted_iv,
        sum(implied_volatility * abs(vega) * open_interest) / nullif(sum(abs(vega) * open_interest), 0) AS vega_weighted_iv, CAST(sum(open_interest) AS BIGINT) AS total_oi, count(*) AS num_options, count(*) FILTER (option_type = 'Call') AS num_calls
      FROM b GROUP BY ticker, trade_date, expiry_date, days_to_expiry, underlying_price),
c AS (SELECT *, call_25d_iv - put_25d_iv AS risk_reversal_25d, (call_25d_iv + put_25d_iv) / 2 - atm_iv AS butterfly_25d, otm_put_iv - atm_iv AS put_skew, otm_call_iv - atm_iv AS call_skew, (otm_put_iv - otm_call_iv) / nullif(atm_iv, 0) * 100 AS skew_asymmetry_pct FROM a),
e AS (SELECT ticker, trade_date, avg(atm_iv) FILTER (days_to_expiry < 30) AS near_term_iv, avg(atm_iv) FILTER (days_to_expiry BETWEEN 30 AND 90) AS mid_term_iv, avg(atm_iv) FILTER (days_to_expiry > 90) AS far_term_iv FROM c GROUP BY ticker, trade_date),
s AS (SELECT c.*, near_term_iv, mid_term_iv, far_term_iv, round(near_term_iv - far_term_iv, 9) AS term_structure_slope,
        CASE WHEN round(near_term_iv - far_term_iv, 9) > 0 THEN 'Normal (Contango)' WHEN round(near_term_iv - far_term_iv, 9) < 0 THEN 'Inverted (Backwardation)' ELSE 'Flat' END AS term_structure_shape,
        CASE WHEN round(put_skew, 9) > 0.05 THEN 'Steep Put Skew' WHEN round(put_skew, 9) > 0.02 THEN 'Moderate Put Skew' WHEN round(put_skew, 9) < -0.02 THEN 'Negative Put Skew' ELSE 'Flat' END AS put_skew_classification,
        CASE WHEN round(risk_reversal_25d, 9) < -0.03 THEN 'Very Bearish' WHEN round(risk_reversal_25d, 9) < -0.01 THEN 'Bearish' WHEN round(risk_reversal_25d, 9) > 0.03 THEN 'Very Bullish' WHEN round(risk_reversal_25d, 9) > 0.01 THEN 'Bullish' ELSE 'Neutral' END AS sentiment_from_rr,
        CASE WHEN round(butterfly_25d, 9) > 0.03 THEN 'High Tail Risk Premium' WHEN round(butterfly_25d, 9) > 0.01 THEN 'Moderate Tail Risk' ELSE 'Low Tail Risk' END AS tail_risk_classification,
        CASE WHEN days_to_expiry <= 7 THEN 'Weekly' WHEN days_to_expiry <= 30 THEN 'Monthly' WHEN days_to_expiry <= 90 THEN 'Quarterly' ELSE 'LEAPS' END AS expiry_bucket FROM c LEFT JOIN e USING (ticker, trade_date))
SELECT {sql_rounded(SKEW)} FROM s""",
)
def volatility_skew_query(spark, sf_dir):
    return select_rounded(volatility_skew(chain_of(spark, sf_dir)), SKEW)


# Term structure


def term_structure(chain: DataFrame, least: int = 1) -> DataFrame:
    """Median at-the-money volatility by expiry, with slope to the next expiry, premium over the front one and daily change.
    Rows of fewer than `least` contracts or without volume are unreliable and left out."""
    own = when_call(F.col("option_type"), F.col("underlying_price") / F.col("strike"), F.col("strike") / F.col("underlying_price"))
    rows = chain.where(F.col("greeks_valid") & (F.col("implied_volatility") > 0) & (F.col("expiry_date") > F.col("trade_date")) & own.between(0.95, 1.05))
    per = rows.groupBy("ticker", "trade_date", "expiry_date", "option_type", "days_to_expiry").agg(
        F.percentile("implied_volatility", F.lit(0.5)).alias("atm_iv"), F.avg("implied_volatility").alias("avg_iv"), F.min("implied_volatility").alias("min_iv"), F.max("implied_volatility").alias("max_iv"), F.count("*").alias("option_count"),
        F.sum("volume").alias("total_volume"), F.sum("open_interest").alias("total_oi"), F.avg("underlying_price").alias("underlying_price"),
    )
    across = Window.partitionBy("ticker", "trade_date", "option_type").orderBy("expiry_date")
    along = Window.partitionBy("ticker", "expiry_date", "option_type").orderBy("trade_date")
    iv, slope, v = F.col("atm_iv"), F.round("iv_slope_to_next", 9), F.col("total_volume")
    out = per.withColumns({
        "iv_slope_to_next": F.lead(iv).over(across) - iv, "iv_change_1d": iv - F.lag(iv).over(along), "term_premium": iv - F.first(iv).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "term_rank": F.row_number().over(across).cast("long"), "years": F.col("days_to_expiry") / 365,
    }).withColumns({
        "regime": F.when(F.col("term_rank") == 1, None).when(slope > 0, "Contango").when(slope < 0, "Backwardation").otherwise("Flat"),
        "liquidity_tier": F.when((v > 50) & (F.col("total_oi") > 100), "High").when((v > 10) & (F.col("total_oi") > 50), "Medium").otherwise("Low"),
    })
    return out.where((F.col("option_count") >= least) & (v > 0))


TERM = names(
    "ticker trade_date expiry_date option_type days_to_expiry years term_rank atm_iv avg_iv min_iv max_iv iv_change_1d term_premium iv_slope_to_next regime total_volume total_oi option_count underlying_price liquidity_tier",
    years=6, atm_iv=6, avg_iv=6, min_iv=6, max_iv=6, iv_change_1d=6, term_premium=6, iv_slope_to_next=6, underlying_price=4,
)


@register(
    "volatility_term_structure",
    f"""
WITH {CHAIN},
a AS (SELECT ticker, trade_date, expiry_date, option_type, days_to_expiry, days_to_expiry / 365.0 AS years, percentile_cont(0.5) WITHIN GROUP (ORDER BY implied_volatility) AS atm_iv, avg(implied_volatility) AS avg_iv, min(implied_volatility) AS min_iv,
        max(implied_volatility) AS max_iv, count(*) AS option_count, CAST(sum(volume) AS BIGINT) AS total_volume, CAST(sum(open_interest) AS BIGINT) AS total_oi, avg(underlying_price) AS underlying_price
      FROM option_chain WHERE greeks_valid AND implied_volatility > 0 AND expiry_date > trade_date AND CASE option_type WHEN 'Call' THEN underlying_price / strike ELSE strike / underlying_price END BETWEEN 0.95 AND 1.05 GROUP BY 1, 2, 3, 4, 5),
w AS (SELECT *, lead(atm_iv) OVER x - atm_iv AS iv_slope_to_next, atm_iv - lag(atm_iv) OVER (PARTITION BY ticker, expiry_date, option_type ORDER BY trade_date) AS iv_change_1d,
        atm_iv - first_value(atm_iv) OVER x AS term_premium, row_number() OVER x AS term_rank FROM a WINDOW x AS (PARTITION BY ticker, trade_date, option_type ORDER BY expiry_date)),
s AS (SELECT *, CASE WHEN term_rank = 1 THEN NULL WHEN round(iv_slope_to_next, 9) > 0 THEN 'Contango' WHEN round(iv_slope_to_next, 9) < 0 THEN 'Backwardation' ELSE 'Flat' END AS regime,
        CASE WHEN total_volume > 50 AND total_oi > 100 THEN 'High' WHEN total_volume > 10 AND total_oi > 50 THEN 'Medium' ELSE 'Low' END AS liquidity_tier FROM w)
SELECT {sql_rounded(TERM)} FROM s WHERE option_count >= 1 AND total_volume > 0""",
)
def term_structure_query(spark, sf_dir):
    return select_rounded(term_structure(chain_of(spark, sf_dir)), TERM)


# Surface


def volatility_surface(chain: DataFrame) -> DataFrame:
    mid = (F.col("bid") + F.col("ask")) / 2
    iv = F.col("implied_volatility")
    rows = chain.where(F.col("greeks_valid") & iv.isNotNull() & (F.col("days_to_expiry") > 0))
    return rows.groupBy("ticker", "trade_date", "expiry_date", "strike", "days_to_expiry", "moneyness").agg(
        F.avg(F.when(is_call(), iv)).alias("call_iv"), F.avg(F.when(is_put(), iv)).alias("put_iv"), F.avg(iv).alias("avg_iv"), sum_if(is_call(), F.col("volume")).alias("call_volume"), sum_if(is_put(), F.col("volume")).alias("put_volume"),
        sum_if(is_call(), F.col("open_interest")).alias("call_oi"), sum_if(is_put(), F.col("open_interest")).alias("put_oi"), F.max("underlying_price").alias("underlying_price"), F.avg(F.when(is_call(), mid)).alias("call_mid"), F.avg(F.when(is_put(), mid)).alias("put_mid"),
    ).withColumn("vol_surface_key", F.concat_ws("_", "ticker", "trade_date", "expiry_date", F.format_string("%.2f", "strike")))


SURFACE = names("vol_surface_key ticker trade_date expiry_date strike days_to_expiry moneyness call_iv put_iv avg_iv call_volume put_volume call_oi put_oi underlying_price call_mid put_mid", moneyness=6, call_iv=6, put_iv=6, avg_iv=6, call_mid=6, put_mid=6)


@register(
    "volatility_surface",
    f"""
WITH {CHAIN},
s AS (SELECT concat(ticker, '_', trade_date, '_', expiry_date, '_', format('{{:.2f}}', strike)) AS vol_surface_key, ticker, trade_date, expiry_date, strike, days_to_expiry, moneyness, avg(implied_volatility) FILTER (option_type = 'Call') AS call_iv,
        avg(implied_volatility) FILTER (option_type = 'Put') AS put_iv, avg(implied_volatility) AS avg_iv, CAST(coalesce(sum(volume) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_volume, CAST(coalesce(sum(volume) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_volume,
        CAST(coalesce(sum(open_interest) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_oi, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_oi, max(underlying_price) AS underlying_price,
        avg((bid + ask) / 2) FILTER (option_type = 'Call') AS call_mid, avg((bid + ask) / 2) FILTER (option_type = 'Put') AS put_mid
      FROM option_chain WHERE greeks_valid AND implied_volatility IS NOT NULL AND days_to_expiry > 0 GROUP BY ALL)
SELECT {sql_rounded(SURFACE)} FROM s""",
)
def volatility_surface_query(spark, sf_dir):
    return select_rounded(volatility_surface(chain_of(spark, sf_dir)), SURFACE)


# Daily summary


def daily_summary(chain: DataFrame) -> DataFrame:
    """One row per ticker and day: volumes, open interest, coverage of quotes, at-the-money strike, skew, exposures and a
    quality score (40 % spreads, 30 % validated Greeks, 30 % liquid contracts). The nearest strike comes from the same
    aggregation as all else."""
    iv, oi, v, valid = F.col("implied_volatility"), F.col("open_interest"), F.col("volume"), F.col("greeks_valid")
    gap = F.round(F.abs(F.col("strike") - F.col("underlying_price")), 6)
    m = F.col("moneyness")
    out = chain.groupBy("ticker", "trade_date").agg(
        F.count("*").alias("total_contracts"), F.count_distinct("strike").alias("num_strikes"), F.count_distinct("expiry_date").alias("num_expiries"), F.sum(v).alias("total_volume"), sum_if(is_call(), v).alias("call_volume"), sum_if(is_put(), v).alias("put_volume"),
        F.sum(oi).alias("total_oi"), sum_if(is_call(), oi).alias("call_oi"), sum_if(is_put(), oi).alias("put_oi"), F.min("strike").alias("min_strike"), F.max("strike").alias("max_strike"), F.avg(iv).alias("avg_implied_vol"),
        F.avg(F.when(F.abs(m - 1) < 0.05, iv)).alias("atm_implied_vol"), F.min(F.struct(gap.alias("gap"), F.col("strike")))["strike"].alias("atm_strike"),
        (F.avg(F.when(valid & (m < 0.95) & is_put(), iv)) - F.avg(F.when(valid & (m < 0.95) & is_call(), iv))).alias("vol_skew"), F.sum(F.when(is_call() & valid, F.col("delta") * oi)).alias("total_call_delta"),
        F.sum(F.when(is_put() & valid, F.col("delta") * oi)).alias("total_put_delta"), F.sum(F.when(valid, F.col("gamma") * oi)).alias("total_gamma"), F.sum(F.when(valid, F.col("vega") * oi)).alias("total_vega"),
        F.count("bid").alias("contracts_with_bid"), F.count(F.when(F.col("bid").isNotNull() & F.col("ask").isNotNull(), 1)).alias("contracts_with_spread"), F.count(F.when(valid, 1)).alias("validated_contracts"),
        F.count(F.when(F.col("is_liquid"), 1)).alias("liquid_contracts"), F.count(F.when(m > 1.02, 1)).alias("itm_contracts"), F.count(F.when(F.abs(m - 1) <= 0.02, 1)).alias("atm_contracts"),
    )
    n = F.col("total_contracts")
    return out.withColumns({
        "call_put_volume_ratio": F.when(F.col("put_volume") > 0, F.col("call_volume") / F.col("put_volume")), "call_put_oi_ratio": F.when(F.col("put_oi") > 0, F.col("call_oi") / F.col("put_oi")),
        "net_delta": F.col("total_call_delta") + F.col("total_put_delta"), "quality_score": F.col("contracts_with_spread") / n * 40 + F.col("validated_contracts") / n * 30 + F.col("liquid_contracts") / n * 30,
    })


SUMMARY = names(
    "ticker trade_date total_contracts num_strikes num_expiries total_volume call_volume put_volume total_oi call_oi put_oi min_strike max_strike avg_implied_vol atm_implied_vol atm_strike vol_skew total_call_delta total_put_delta net_delta total_gamma total_vega contracts_with_bid contracts_with_spread validated_contracts liquid_contracts itm_contracts atm_contracts call_put_volume_ratio call_put_oi_ratio quality_score",
    avg_implied_vol=6, atm_implied_vol=6, vol_skew=6, total_call_delta=3, total_put_delta=3, net_delta=3, total_gamma=4, total_vega=3, call_put_volume_ratio=6, call_put_oi_ratio=6, quality_score=4,
)


@register(
    "options_daily_summary",
    f"""
WITH {CHAIN},
s AS (SELECT ticker, trade_date, count(*) AS total_contracts, count(DISTINCT strike) AS num_strikes, count(DISTINCT expiry_date) AS num_expiries, CAST(sum(volume) AS BIGINT) AS total_volume, CAST(coalesce(sum(volume) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_volume,
        CAST(coalesce(sum(volume) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_volume, CAST(sum(open_interest) AS BIGINT) AS total_oi, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_oi,
        CAST(coalesce(sum(open_interest) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_oi, min(strike) AS min_strike, max(strike) AS max_strike, avg(implied_volatility) AS avg_implied_vol, avg(implied_volatility) FILTER (abs(moneyness - 1) < 0.05) AS atm_implied_vol,
        avg(implied_volatility) FILTER (greeks_valid AND moneyness < 0.95 AND option_type = 'Put') - avg(implied_volatility) FILTER (greeks_valid AND moneyness < 0.95 AND option_type = 'Call') AS vol_skew,
        sum(delta * open_interest) FILTER (greeks_valid AND option_type = 'Call') AS total_call_delta, sum(delta * open_interest) FILTER (greeks_valid AND option_type = 'Put') AS total_put_delta, sum(gamma * open_interest) FILTER (greeks_valid) AS total_gamma,
        sum(vega * open_interest) FILTER (greeks_valid) AS total_vega, count(bid) AS contracts_with_bid, count(*) FILTER (bid IS NOT NULL AND ask IS NOT NULL) AS contracts_with_spread, count(*) FILTER (greeks_valid) AS validated_contracts,
        count(*) FILTER (is_liquid) AS liquid_contracts, count(*) FILTER (moneyness > 1.02) AS itm_contracts, count(*) FILTER (abs(moneyness - 1) <= 0.02) AS atm_contracts FROM option_chain GROUP BY ticker, trade_date),
n AS (SELECT DISTINCT ON (ticker, trade_date) ticker, trade_date, strike AS atm_strike FROM option_chain ORDER BY ticker, trade_date, round(abs(strike - underlying_price), 6), strike),
j AS (SELECT s.*, atm_strike, total_call_delta + total_put_delta AS net_delta, CASE WHEN put_volume > 0 THEN call_volume / put_volume END AS call_put_volume_ratio, CASE WHEN put_oi > 0 THEN call_oi / put_oi END AS call_put_oi_ratio,
        contracts_with_spread / total_contracts * 40 + validated_contracts / total_contracts * 30 + liquid_contracts / total_contracts * 30 AS quality_score FROM s JOIN n USING (ticker, trade_date))
SELECT {sql_rounded(SUMMARY)} FROM j""",
)
def daily_summary_query(spark, sf_dir):
    return select_rounded(daily_summary(chain_of(spark, sf_dir)), SUMMARY)
