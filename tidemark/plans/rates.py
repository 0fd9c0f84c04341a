"""Interest rates by date and term, and Greeks that depend on them: quoted contracts at the chain's volatility, the others at
the median one, quality gates, dividend yields, and rules for moving a volatility with the spot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import pricing
from tidemark.functions.dates import dow0
from tidemark.functions.numbers import safe_div
from tidemark.operators.quantiles import exact_percentile
from tidemark.plans.gold_chain import CHAIN, chain_of, select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.plans.star import solved, solved_sql, valued_sql
from tidemark.plans.strategies import daily_state
from tidemark.session import stored
from tidemark.sources import adapters

# Terms of the curve in years, the rate before the first one is known, volatility where none is, the dividend
# yield, the premium of implied over realised volatility and the share of its spread, limits of the quality gates.
TERMS = [0.0027, 0.25, 1.0, 2.0, 5.0]
DEFAULT_RATE, DEFAULT_IV, YIELD = 0.035, 0.30, 0.02
PREMIUM, SMOOTHER = 0.03, 0.6
DEEP, LEAST_TIME, DEEP_TIME, ERROR, DEEP_ERROR = 0.02, 0.001, -0.05, 0.01, 0.05


def curve_points(spark, sf_dir) -> DataFrame:
    """Rates (curve_date, term, rate) as they were published, with gaps."""
    return adapters.load(spark, sf_dir, "curve_points")


def filled_curve(points: DataFrame, days: DataFrame, default: float = DEFAULT_RATE) -> DataFrame:
    """One row per day (trade_date) with the last known rate of each term, r0 .. r4. A Friday also knows Saturday's."""
    asof = F.date_add("trade_date", F.when(dow0(F.col("trade_date")) == 5, 1).otherwise(0))
    asked = days.select("trade_date", asof.alias("d"), F.explode(F.array(*map(F.lit, range(len(TERMS))))).alias("term"), F.lit(None).cast("double").alias("rate"), F.lit(1).alias("asked"))
    known = points.select(F.lit(None).cast("date").alias("trade_date"), F.col("curve_date").alias("d"), F.col("term").cast("int").alias("term"), "rate", F.lit(0).alias("asked"))
    w = Window.partitionBy("term").orderBy("d", "asked").rowsBetween(Window.unboundedPreceding, 0)
    both = known.unionByName(asked).withColumn("last", F.coalesce(F.last("rate", ignorenulls=True).over(w), F.lit(default))).where("asked = 1")
    return both.groupBy("trade_date").agg(*[F.max(F.when(F.col("term") == i, F.col("last"))).alias(f"r{i}") for i in range(len(TERMS))])


def rate_at(t: Column) -> Column:
    """The rate at t years: straight lines between r0 .. r4, flat beyond them."""
    out = F.when(t <= TERMS[0], F.col("r0"))
    for i in range(1, len(TERMS)):
        a, b = F.col(f"r{i - 1}"), F.col(f"r{i}")
        out = out.when(t <= TERMS[i], a + (t - TERMS[i - 1]) * (b - a) / (TERMS[i] - TERMS[i - 1]))
    return out.otherwise(F.col(f"r{len(TERMS) - 1}"))


def _rate_sql(t: str) -> str:
    arms = [f"WHEN {t} <= {TERMS[0]} THEN r0"] + [f"WHEN {t} <= {TERMS[i]} THEN r{i - 1} + ({t} - {TERMS[i - 1]}) * (r{i} - r{i - 1}) / {TERMS[i] - TERMS[i - 1]}" for i in range(1, len(TERMS))]
    return f"CASE {' '.join(arms)} ELSE r{len(TERMS) - 1} END"


CURVE_CTE = f"""{adapters.oracle("curve_points")},
cd AS (SELECT DISTINCT trade_date, trade_date + CASE WHEN dayofweek(trade_date) = 5 THEN 1 ELSE 0 END AS d FROM option_chain),
ck AS (SELECT trade_date, term, coalesce((SELECT arg_max(rate, curve_date) FROM curve_points p WHERE p.term = t.term AND p.curve_date <= cd.d), {DEFAULT_RATE}) AS rate FROM cd, (VALUES (0), (1), (2), (3), (4)) t(term)),
cf AS (SELECT trade_date, {", ".join(f"max(rate) FILTER (term = {i}) AS r{i}" for i in range(len(TERMS)))} FROM ck GROUP BY trade_date)"""
RATES = {"trade_date": None, "days_to_expiry": None, "overnight": 6, "rate": 6}


def with_rates(chain: DataFrame, curve: DataFrame) -> DataFrame:
    return chain.join(curve, "trade_date").withColumn("rate", rate_at(F.greatest(F.col("days_to_expiry"), F.lit(1)) / 365.0))


@register("contract_rates", adapters.doubles(f"WITH {CHAIN},{CURVE_CTE}, x AS (SELECT DISTINCT trade_date, days_to_expiry FROM option_chain), y AS (SELECT trade_date, days_to_expiry, r0 AS overnight, {_rate_sql('(greatest(days_to_expiry, 1) / 365.0)')} AS rate FROM x JOIN cf USING (trade_date)) SELECT {sql_rounded(RATES)} FROM y"))
def contract_rates(spark, sf_dir):
    """The term-matched rate of each day and term that the chain holds."""
    asked = chain_of(spark, sf_dir).select("trade_date", "days_to_expiry").distinct()
    out = with_rates(asked, filled_curve(curve_points(spark, sf_dir), asked.select("trade_date").distinct()))
    return select_rounded(out.withColumn("overnight", F.col("r0")), RATES)


# Greeks in two passes


def price_for_greeks(intrinsic: Column) -> Column:
    """The last price, or the middle where none was paid; the ask where that is under the intrinsic value."""
    base = F.when(F.col("last_price") > 0, F.col("last_price")).otherwise((F.col("bid") + F.col("ask")) / 2)
    return F.when((base < intrinsic) & F.col("ask").isNotNull(), F.col("ask")).otherwise(base)


def two_passes(chain: DataFrame) -> DataFrame:
    """Contracts with a price keep the volatility solved from it if it passes the gates; the others are priced at the day's median
    of those, or DEFAULT_IV, and marked as estimated. Greeks that fail a gate are null.

    The chain with what is solved is stored once; the medians, over all contracts of a day, read it, and so does the second pass.
    d1, the distributions and prices are columns of their own, so that no generated method outgrows the compiler."""
    s, k, kind = F.col("underlying_price"), F.col("strike"), F.col("option_type")
    inner = F.greatest(F.when(kind == "Call", s - k).otherwise(k - s), F.lit(0.0))
    x = chain.withColumns({"t": F.greatest(F.col("days_to_expiry"), F.lit(1)) / 365.0, "inner": inner}).withColumn("paid", price_for_greeks(F.col("inner")))
    m = s / k
    deep = (m > 1 + DEEP) | (m < 1 - DEEP)
    t, r, paid, iv = F.col("t"), F.col("rate"), F.col("paid"), F.col("iv")
    least = F.when(deep, DEEP_TIME).otherwise(LEAST_TIME)
    x = solved(x, paid, t, r)
    x = x.withColumn("d1", pricing.d1(s, k, t, r, iv)).withColumn("market_price", pricing.price(kind, s, k, t, r, iv, F.col("d1")))
    timed = (paid > 0) & m.between(0.1, 10) & (paid - F.col("inner") >= least)
    market = iv.between(0.05, F.when(deep, 5.0).otherwise(2.0))
    near = F.abs(F.col("market_price") - paid) <= paid * F.when(deep, DEEP_ERROR).otherwise(ERROR)
    x = stored(x.withColumn("iv1", F.when(timed & market & near, iv)).drop("iv", "d1"))
    median = exact_percentile(x, ["trade_date"], "iv1", 0.5, "median_iv")
    x = x.join(median, "trade_date", "left").withColumn("median_iv", F.coalesce("median_iv", F.lit(DEFAULT_IV))).withColumn("is_estimated", F.coalesce(paid <= 0, F.lit(True)))
    x = x.withColumn("iv", F.when(F.col("is_estimated"), F.col("median_iv")).otherwise(F.col("iv1")))
    x = x.withColumn("d1", pricing.d1(s, k, t, r, iv)).withColumn("estimated_price", F.when(F.col("is_estimated"), pricing.price(kind, s, k, t, r, iv, F.col("d1"))))
    enough = ~F.col("is_estimated") | (m.between(0.1, 10) & (F.col("estimated_price") > 0) & (F.col("estimated_price") - F.col("inner") >= least))
    x = x.withColumn("iv", F.when(enough, iv)).withColumn("d1", F.when(iv.isNotNull(), F.col("d1")))
    d = F.col("d1")
    return x.withColumns({"delta": pricing.delta(kind, s, k, t, r, iv, d), "gamma": F.when(iv.isNotNull(), pricing.gamma(s, k, t, r, iv, d)), "vega": F.when(iv.isNotNull(), pricing.vega(s, k, t, r, iv, d))})


PASSES = dict.fromkeys(["ticker", "option_type", "strike", "expiry_date", "trade_date", "is_estimated"]) | {"paid": 4, "median_iv": 6, "iv": 6, "estimated_price": 4, "delta": 6, "gamma": 6, "vega": 6}
_D1 = "least(greatest((ln(underlying_price / strike) + (rate + {v} * {v} / 2.0) * t) / ({v} * sqrt(t)), -10.0), 10.0)"


def _price_sql(a: str, v: str) -> str:
    call = f"greatest(underlying_price * {pricing.cdf_sql(a)} - strike * exp(-rate * t) * {pricing.cdf_sql(f'({a} - {v} * sqrt(t))')}, underlying_price - strike, 0.0)"
    put = f"greatest(strike * exp(-rate * t) * (1.0 - {pricing.cdf_sql(f'({a} - {v} * sqrt(t))')}) - underlying_price * (1.0 - {pricing.cdf_sql(a)}), strike - underlying_price, 0.0)"
    return f"CASE option_type WHEN 'Call' THEN {call} ELSE {put} END"


def _hidden(chain: DataFrame) -> DataFrame:
    """The chain with prices for the contracts that were quoted alone."""
    return chain.withColumns({c: F.when(F.col("bid").isNotNull(), F.col(c)) for c in ("last_price", "ask")})


@register(
    "two_pass_greeks",
    adapters.doubles(f"""
WITH RECURSIVE {CHAIN},{CURVE_CTE},
a AS (SELECT row_number() OVER () AS id, o.* EXCLUDE (last_price, ask), CASE WHEN bid IS NOT NULL THEN last_price END AS last_price, CASE WHEN bid IS NOT NULL THEN ask END AS ask, greatest(days_to_expiry, 1) / 365.0 AS t, greatest(CASE option_type WHEN 'Call' THEN underlying_price - strike ELSE strike - underlying_price END, 0.0) AS inner_value,
        {_rate_sql("(greatest(days_to_expiry, 1) / 365.0)")} AS rate, (underlying_price / strike > 1.02 OR underlying_price / strike < 0.98) AS deep FROM option_chain o JOIN cf USING (trade_date)),
b AS (SELECT *, CASE WHEN last_price > 0 THEN last_price ELSE (bid + ask) / 2 END AS base FROM a),
c AS MATERIALIZED (SELECT *, CASE WHEN base < inner_value AND ask IS NOT NULL THEN ask ELSE base END AS paid FROM b),
{solved_sql("c")},
{valued_sql("iv", "c_iv", "market_price")},
e AS MATERIALIZED (SELECT * EXCLUDE (iv), CASE WHEN paid > 0 AND underlying_price / strike BETWEEN 0.1 AND 10 AND paid - inner_value >= if(deep, {DEEP_TIME}, {LEAST_TIME}) AND iv BETWEEN 0.05 AND if(deep, 5.0, 2.0) AND abs(market_price - paid) <= paid * if(deep, {DEEP_ERROR}, {ERROR}) THEN iv END AS iv1 FROM c_iv_market_price),
m AS (SELECT trade_date, coalesce(median(iv1), {DEFAULT_IV}) AS median_iv FROM e GROUP BY trade_date),
f AS MATERIALIZED (SELECT e.*, median_iv, coalesce(paid <= 0, true) AS is_estimated, CASE WHEN coalesce(paid <= 0, true) THEN median_iv ELSE iv1 END AS iv0 FROM e JOIN m USING (trade_date)),
g AS MATERIALIZED (SELECT *, {_D1.format(v="iv0")} AS db FROM f),
h AS MATERIALIZED (SELECT *, CASE WHEN is_estimated THEN {_price_sql("db", "iv0")} END AS estimated_price FROM g),
i AS (SELECT *, CASE WHEN NOT is_estimated OR (underlying_price / strike BETWEEN 0.1 AND 10 AND estimated_price > 0 AND estimated_price - inner_value >= if(deep, {DEEP_TIME}, {LEAST_TIME})) THEN iv0 END AS iv FROM h),
j AS (SELECT * EXCLUDE (delta, gamma, vega), CASE WHEN iv IS NOT NULL THEN {pricing.cdf_sql("db")} - CASE option_type WHEN 'Call' THEN 0.0 ELSE 1.0 END END AS delta, CASE WHEN iv IS NOT NULL THEN exp(-db * db / 2.0) / sqrt(2.0 * pi()) / (underlying_price * iv * sqrt(t)) END AS gamma,
        CASE WHEN iv IS NOT NULL THEN underlying_price * exp(-db * db / 2.0) / sqrt(2.0 * pi()) * sqrt(t) / 100.0 END AS vega FROM i)
SELECT {sql_rounded(PASSES)} FROM j"""),
)
def two_pass_greeks(spark, sf_dir):
    chain = chain_of(spark, sf_dir).drop("delta", "gamma", "vega")
    curve = filled_curve(curve_points(spark, sf_dir), chain.select("trade_date").distinct())
    out = two_passes(with_rates(_hidden(chain), curve))
    return select_rounded(out.withColumn("delta", F.when(F.col("iv").isNotNull(), F.col("delta"))), PASSES)


# Dividend yield

YIELDED = dict.fromkeys(["ticker", "option_type", "strike", "expiry_date", "trade_date"]) | {"price_q": 4, "delta_q": 6, "gamma_q": 6, "vega_q": 6, "theta_q": 6}


@register(
    "dividend_greeks",
    adapters.doubles(f"""
WITH {CHAIN},
a AS MATERIALIZED (SELECT *, days_to_expiry / 365.0 AS t, (ln(underlying_price / strike) + ({adapters.RATE} - {YIELD} + implied_volatility * implied_volatility / 2.0) * (days_to_expiry / 365.0)) / (implied_volatility * sqrt(days_to_expiry / 365.0)) AS d1 FROM option_chain WHERE days_to_expiry > 0),
b AS MATERIALIZED (SELECT *, d1 - implied_volatility * sqrt(t) AS d2, underlying_price * exp(-{YIELD} * t) AS fs, strike * exp(-{adapters.RATE} * t) AS fk, exp(-d1 * d1 / 2.0) / sqrt(2.0 * pi()) AS pdf FROM a),
c AS MATERIALIZED (SELECT *, {pricing.cdf_sql("d1")} AS n1, {pricing.cdf_sql("d2")} AS n2 FROM b),
d AS (SELECT *, option_type = 'Call' AS is_call, -(fs * pdf * implied_volatility) / (2.0 * sqrt(t)) AS decay FROM c),
e AS (SELECT *, CASE WHEN is_call THEN fs * n1 - fk * n2 ELSE fk * (1.0 - n2) - fs * (1.0 - n1) END AS price_q, exp(-{YIELD} * t) * CASE WHEN is_call THEN n1 ELSE n1 - 1.0 END AS delta_q, exp(-{YIELD} * t) * pdf / (underlying_price * implied_volatility * sqrt(t)) AS gamma_q, fs * pdf * sqrt(t) / 100.0 AS vega_q,
        (decay - CASE WHEN is_call THEN {YIELD} * fs * n1 - {adapters.RATE} * fk * n2 ELSE {YIELD} * fs * (1.0 - n1) + {adapters.RATE} * fk * (1.0 - n2) END) / 365.0 AS theta_q FROM d)
SELECT {sql_rounded(YIELDED)} FROM e"""),
)
def dividend_greeks(spark, sf_dir):
    """Price and Greeks with a continuous dividend yield."""
    s, k, t, kind, v = F.col("underlying_price"), F.col("strike"), F.col("days_to_expiry") / 365.0, F.col("option_type"), F.col("implied_volatility")
    r, q = F.lit(adapters.RATE), F.lit(YIELD)
    out = chain_of(spark, sf_dir).where("days_to_expiry > 0").withColumn("price_q", pricing.price_with_yield(kind, s, k, t, r, v, q)).withColumn("g", pricing.greeks_with_yield(kind, s, k, t, r, v, q))
    return select_rounded(out.withColumns({f"{c}_q": F.col(f"g.{c}") for c in ("delta", "gamma", "vega", "theta")}), YIELDED)


# The volatility model

CALIBRATION = {"ticker": None, "n_days": None, "rv_mean": 6, "iv_mean": 6, "iv_vol": 6}
STATE_CTE = "n AS (SELECT ticker, trade_date, max(underlying_price) AS spot, arg_min(implied_volatility, row(round(abs(strike - underlying_price), 6), strike, implied_volatility)) AS iv FROM option_chain GROUP BY 1, 2)"


def realised(state: DataFrame, n: int = 20) -> DataFrame:
    """Adds ret and rv, the yearly spread of the last n log returns."""
    w = Window.partitionBy("ticker").orderBy("trade_date")
    last = w.rowsBetween(-(n - 1), 0)
    out = state.withColumn("ret", F.log(F.col("spot") / F.lag("spot").over(w)))
    return out.withColumn("rv", F.when(F.count("ret").over(last) >= n, F.stddev_samp("ret").over(last)) * F.sqrt(F.lit(252.0)))


REALISED_CTE = f"""{STATE_CTE},
ra AS (SELECT *, ln(spot / lag(spot) OVER w) AS ret FROM n WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
rb AS (SELECT *, CASE WHEN count(ret) OVER f >= 20 THEN stddev_samp(ret) OVER f END * sqrt(252) AS rv FROM ra WINDOW f AS (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING))"""


@register("iv_calibration", f"WITH {CHAIN},{REALISED_CTE}, c AS (SELECT ticker, count(rv) AS n_days, avg(rv) AS rv_mean, avg(rv) + {PREMIUM} AS iv_mean, stddev_pop(rv) * {SMOOTHER} AS iv_vol FROM rb GROUP BY ticker) SELECT {sql_rounded(CALIBRATION)} FROM c")
def iv_calibration(spark, sf_dir):
    """Level and spread of implied volatility from realised volatility: its mean and a premium, a part of its spread."""
    rows = realised(daily_state(chain_of(spark, sf_dir)))
    out = rows.groupBy("ticker").agg(F.count("rv").alias("n_days"), F.avg("rv").alias("rv_mean"), (F.avg("rv") + PREMIUM).alias("iv_mean"), (F.stddev_pop("rv") * SMOOTHER).alias("iv_vol"))
    return select_rounded(out, CALIBRATION)


def sticky(rule: str, iv: Column, strike: Column, old_spot: Column) -> Column:
    """What a move of the spot leaves: by strike the old volatility, by delta the old moneyness to look it up at."""
    return iv if rule == "strike" else safe_div(strike, old_spot)


STICKY = dict.fromkeys(["ticker", "option_type", "strike", "expiry_date", "trade_date"]) | {"iv_by_strike": 6, "moneyness_by_delta": 6, "iv_error": 6}


@register(
    "sticky_rules",
    f"""
WITH {CHAIN},
a AS (SELECT *, lag(implied_volatility) OVER w AS old_iv, lag(underlying_price) OVER w AS old_spot FROM option_chain WINDOW w AS (PARTITION BY ticker, option_type, strike, expiry_date ORDER BY trade_date)),
b AS (SELECT *, old_iv AS iv_by_strike, strike / nullif(old_spot, 0) AS moneyness_by_delta, implied_volatility - old_iv AS iv_error FROM a WHERE old_iv IS NOT NULL)
SELECT {sql_rounded(STICKY)} FROM b""",
)
def sticky_rules(spark, sf_dir):
    """Each contract's volatility under both rules after the spot moved, and how far the market's was from the first."""
    w = Window.partitionBy("ticker", "option_type", "strike", "expiry_date").orderBy("trade_date")
    x = chain_of(spark, sf_dir).withColumns({"old_iv": F.lag("implied_volatility").over(w), "old_spot": F.lag("underlying_price").over(w)}).where("old_iv is not null")
    iv, k, s = F.col("old_iv"), F.col("strike"), F.col("old_spot")
    return select_rounded(x.withColumns({"iv_by_strike": sticky("strike", iv, k, s), "moneyness_by_delta": sticky("delta", iv, k, s), "iv_error": F.col("implied_volatility") - iv}), STICKY)
