"""Gamma exposure by strike, weekly exposure with its flip level, max pain, and the key levels drawn from them.

Open interest is taken from the last session of each week. Dealers are short options: calls count negative, puts positive.
Ties in rankings go to the lower strike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import dow0, week_friday
from tidemark.functions.numbers import safe_div, sum_if, when_call
from tidemark.operators.rows import latest_by, ranked
from tidemark.plans.registry import register
from tidemark.sources import adapters

CONTRACT = 100
LAST_SESSIONS = (4, 5, 6)
EXPIRY = ["ticker", "trade_date", "expiry_date"]


def r(c: Column | str, n: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def steps(value: Column, bands: list[tuple[float, object]], rest: object) -> Column:
    """First band whose upper bound the value does not exceed."""
    out = F
    for top, name in bands:
        out = out.when(value <= top, name)
    return out.otherwise(rest)


def week_last(chain: DataFrame) -> DataFrame:
    """Each contract's last session of the week, Friday before others."""
    keys = [F.date_trunc("week", "trade_date").alias("week"), "ticker", "expiry_date", "strike", "option_type"]
    some = chain.where(F.col("gamma").isNotNull() & (F.col("open_interest") > 0) & (F.col("underlying_price") > 0) & dow0(F.col("trade_date")).isin(*LAST_SESSIONS))
    w = Window.partitionBy(*keys[1:], keys[0]).orderBy(F.when(dow0(F.col("trade_date")) == 5, 0).otherwise(1), F.desc("trade_date"))
    return some.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def gamma_exposure(chain: DataFrame) -> DataFrame:
    gross = F.col("open_interest") * F.col("gamma") * CONTRACT * F.col("underlying_price") * F.col("underlying_price")
    call = F.col("option_type") == "Call"
    rows = week_last(chain.where("greeks_valid")).withColumns({"gross": gross, "dealer": when_call(F.col("option_type"), -gross, gross, F.lit(0.0)), "time_weight": steps(F.col("days_to_expiry"), [(7, 1.5), (30, 1.0), (60, 0.7)], 0.4)})
    strikes = rows.groupBy(*EXPIRY, "strike", "underlying_price").agg(
        sum_if(call, F.col("open_interest")).alias("call_oi"),
        sum_if(~call, F.col("open_interest")).alias("put_oi"),
        F.sum("open_interest").alias("total_oi"),
        sum_if(call, F.col("gross")).alias("call_gamma_notional"),
        sum_if(~call, F.col("gross")).alias("put_gamma_notional"),
        F.sum("dealer").alias("net_dealer_gex"),
        sum_if(call, F.col("dealer")).alias("call_dealer_gex"),
        sum_if(~call, F.col("dealer")).alias("put_dealer_gex"),
        F.sum(F.col("dealer") * F.col("time_weight")).alias("weighted_dealer_gex"),
        F.sum(F.col("open_interest") * F.col("delta") * CONTRACT).alias("net_delta_exposure"),
        F.sum(F.col("open_interest") * F.col("vega") * CONTRACT).alias("net_vega_exposure"),
        F.avg("implied_volatility").alias("avg_iv"),
        (F.max("implied_volatility") - F.min("implied_volatility")).alias("iv_spread"),
        F.max("days_to_expiry").alias("days_to_expiry"),
    )
    whole = Window.partitionBy(*EXPIRY)
    size, gap = F.abs("net_dealer_gex"), F.abs(F.col("strike") - F.col("underlying_price"))
    total = F.col("expiry_total_gex")
    out = strikes.withColumns({"expiry_total_gex": F.sum(size).over(whole), "expiry_net_gex": F.sum("net_dealer_gex").over(whole), "gex_rank": F.row_number().over(whole.orderBy(F.desc(F.round(size, 6)), "strike"))})
    kind = F.when(size > total * 0.15, "Gamma Wall").when(size > total * 0.05, "High GEX").when(size < total * 0.01, "Low GEX").otherwise("Medium GEX")
    return out.withColumns(
        {
            "put_call_oi_ratio": safe_div(F.col("put_oi"), F.col("call_oi")),
            "gex_concentration_pct": safe_div(size, total) * 100,
            "gex_classification": kind,
            "moneyness_bucket": F.when(safe_div(gap, F.col("underlying_price")) < 0.02, "ATM").when(F.col("strike") > F.col("underlying_price"), "OTM Call / ITM Put").otherwise("ITM Call / OTM Put"),
            "strike_distance_pct": safe_div(F.col("strike") - F.col("underlying_price"), F.col("underlying_price")) * 100,
            "is_top_3_gex": F.col("gex_rank") <= 3,
            "is_gamma_wall": kind == "Gamma Wall",
            "is_near_spot": gap < F.col("underlying_price") * 0.01,
        }
    )


GAMMA_COLUMNS = {
    "call_oi": 0, "put_oi": 0, "total_oi": 0, "put_call_oi_ratio": 6, "net_dealer_gex": 2, "call_dealer_gex": 2, "put_dealer_gex": 2, "weighted_dealer_gex": 2, "call_gamma_notional": 2, "put_gamma_notional": 2,
    "net_delta_exposure": 3, "net_vega_exposure": 3, "avg_iv": 6, "iv_spread": 6, "gex_concentration_pct": 4, "strike_distance_pct": 6, "expiry_total_gex": 2, "expiry_net_gex": 2,
}
KEPT = ["gex_classification", "moneyness_bucket", "is_top_3_gex", "is_gamma_wall", "is_near_spot", "days_to_expiry", "underlying_price", "strike"]

WEEK_LAST_SQL = """
  week_rows AS (
    SELECT *, row_number() OVER (PARTITION BY date_trunc('week', trade_date), ticker, expiry_date, strike, option_type
                                 ORDER BY CASE WHEN dayofweek(trade_date) = 5 THEN 0 ELSE 1 END, trade_date DESC) AS rn
    FROM option_chain WHERE greeks_valid AND gamma IS NOT NULL AND open_interest > 0 AND underlying_price > 0 AND dayofweek(trade_date) IN (4, 5, 6)),
  exposures AS (
    SELECT *, open_interest * gamma * 100 * underlying_price * underlying_price AS gross, CASE option_type WHEN 'Call' THEN -1 ELSE 1 END AS side,
           CASE WHEN days_to_expiry <= 7 THEN 1.5 WHEN days_to_expiry <= 30 THEN 1.0 WHEN days_to_expiry <= 60 THEN 0.7 ELSE 0.4 END AS weight
    FROM week_rows WHERE rn = 1),
  gex_strikes AS (
    SELECT ticker, trade_date, expiry_date, strike, underlying_price, max(days_to_expiry) AS days_to_expiry,
           CAST(coalesce(sum(open_interest) FILTER (side = -1), 0) AS BIGINT) AS call_oi, CAST(coalesce(sum(open_interest) FILTER (side = 1), 0) AS BIGINT) AS put_oi, CAST(sum(open_interest) AS BIGINT) AS total_oi,
           coalesce(sum(gross) FILTER (side = -1), 0) AS call_gamma_notional, coalesce(sum(gross) FILTER (side = 1), 0) AS put_gamma_notional,
           sum(gross * side) AS net_dealer_gex, coalesce(sum(gross * side) FILTER (side = -1), 0) AS call_dealer_gex, coalesce(sum(gross * side) FILTER (side = 1), 0) AS put_dealer_gex,
           sum(gross * side * weight) AS weighted_dealer_gex, sum(open_interest * delta * 100) AS net_delta_exposure, sum(open_interest * vega * 100) AS net_vega_exposure,
           avg(implied_volatility) AS avg_iv, max(implied_volatility) - min(implied_volatility) AS iv_spread
    FROM exposures GROUP BY ticker, trade_date, expiry_date, strike, underlying_price),
  gex AS (
    SELECT *, sum(abs(net_dealer_gex)) OVER w AS expiry_total_gex, sum(net_dealer_gex) OVER w AS expiry_net_gex,
           row_number() OVER (PARTITION BY ticker, trade_date, expiry_date ORDER BY round(abs(net_dealer_gex), 6) DESC, strike) AS gex_rank,
           CAST(put_oi AS DOUBLE) / nullif(call_oi, 0) AS put_call_oi_ratio
    FROM gex_strikes WINDOW w AS (PARTITION BY ticker, trade_date, expiry_date)),
  gex_named AS (
    SELECT *, abs(net_dealer_gex) / nullif(expiry_total_gex, 0) * 100 AS gex_concentration_pct,
           CASE WHEN abs(net_dealer_gex) > expiry_total_gex * 0.15 THEN 'Gamma Wall' WHEN abs(net_dealer_gex) > expiry_total_gex * 0.05 THEN 'High GEX'
                WHEN abs(net_dealer_gex) < expiry_total_gex * 0.01 THEN 'Low GEX' ELSE 'Medium GEX' END AS gex_classification,
           CASE WHEN abs(strike - underlying_price) / underlying_price < 0.02 THEN 'ATM' WHEN strike > underlying_price THEN 'OTM Call / ITM Put' ELSE 'ITM Call / OTM Put' END AS moneyness_bucket,
           (strike - underlying_price) / underlying_price * 100 AS strike_distance_pct, gex_rank <= 3 AS is_top_3_gex, abs(strike - underlying_price) < underlying_price * 0.01 AS is_near_spot
    FROM gex)"""


@register(
    "gamma_exposure",
    f"WITH {adapters.oracle('option_chain')},{WEEK_LAST_SQL} SELECT ticker, trade_date, expiry_date, CAST(gex_rank AS BIGINT) AS gex_rank, gex_classification = 'Gamma Wall' AS is_gamma_wall, "
    + ", ".join([f"round({c}, {n}) AS {c}" if n else c for c, n in GAMMA_COLUMNS.items()] + [k for k in KEPT if k != "is_gamma_wall"])
    + " FROM gex_named",
)
def gamma_exposure_query(spark, sf_dir):
    out = gamma_exposure(adapters.load(spark, sf_dir, "option_chain"))
    return out.select(*EXPIRY, F.col("gex_rank").cast("long").alias("gex_rank"), *[r(c, n).alias(c) if n else F.col(c) for c, n in GAMMA_COLUMNS.items()], *KEPT)


# Weekly exposure


def weekly_exposure(chain: DataFrame, top: int = 50) -> DataFrame:
    """Exposure of each week's last session by strike, with the strike at which its sign flips: of the strikes whose sign
    differs from that of the other strike nearest to spot, the one nearest to spot. Ranking by distance gives each row its
    nearest other (rank 1, or rank 2 for the first itself) without a join of strikes with strikes."""
    some = chain.where((F.col("open_interest") > 0) & (F.col("gamma") > 0) & (F.col("underlying_price") > 0) & dow0(F.col("trade_date")).isin(*LAST_SESSIONS))
    some = latest_by(some.withColumn("week_ending", week_friday(F.col("trade_date"))), ["week_ending", "ticker", "option_type", "strike", "expiry_date"], [F.desc("trade_date")])
    call = F.col("option_type") == "Call"
    gross = F.col("open_interest") * F.col("gamma") * CONTRACT * F.col("underlying_price") * F.col("underlying_price")
    rows = some.withColumns({"gross": gross, "dealer": when_call(F.col("option_type"), -gross, gross), "time_weight": steps(F.col("days_to_expiry"), [(7, 2.0), (30, 1.5), (60, 1.0), (120, 0.6)], 0.3)})
    keys = ["week_ending", "ticker", "expiry_date"]
    strikes = rows.groupBy(*keys, "strike").agg(
        F.max("trade_date").alias("friday_trade_date"),
        F.avg("underlying_price").alias("underlying_price"),
        F.max("days_to_expiry").alias("days_to_expiry"),
        sum_if(call, F.col("open_interest")).alias("call_oi"),
        sum_if(~call, F.col("open_interest")).alias("put_oi"),
        F.sum("dealer").alias("net_dealer_gex"),
        F.sum(F.col("dealer") * F.col("time_weight")).alias("time_weighted_gex"),
        F.sum("gross").alias("total_gross_gex"),
        F.sum(F.col("open_interest") * F.col("last_price") * CONTRACT).alias("total_notional_eur"),
        F.avg(F.when(call, F.col("implied_volatility"))).alias("call_iv"),
        F.avg(F.when(~call, F.col("implied_volatility"))).alias("put_iv"),
        F.avg("implied_volatility").alias("avg_iv"),
    )
    whole, week = Window.partitionBy(*keys), Window.partitionBy("week_ending", "ticker")
    gap, size, sign = F.abs(F.col("strike") - F.col("underlying_price")), F.abs("net_dealer_gex"), F.signum("net_dealer_gex")
    near = whole.orderBy("gap", "strike")
    full = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = strikes.withColumn("gap", F.round(gap, 6)).withColumns({"near_rank": F.row_number().over(near), "sign_1": F.first(sign).over(full), "sign_2": F.nth_value(sign, 2).over(full)})
    flips = F.when(sign != F.when(F.col("near_rank") == 1, F.col("sign_2")).otherwise(F.col("sign_1")), F.struct("gap", "strike"))
    s = s.withColumns({
        "gamma_flip_strike": F.min(flips).over(whole)["strike"],
        "expiry_gex": F.sum(size).over(whole),
        "expiry_net_gex": F.sum("net_dealer_gex").over(whole),
        "portfolio_net_gex": F.sum("net_dealer_gex").over(week),
        "gex_rank": F.row_number().over(whole.orderBy(F.desc(F.round(size, 6)), "strike")).cast("long"),
    })
    total, flip, spot = F.col("expiry_gex"), F.col("gamma_flip_strike"), F.col("underlying_price")
    return s.where(F.col("gex_rank") <= top).withColumns({
        "gex_tier": F.when(size > total * 0.20, "Gamma Wall").when(size > total * 0.10, "High GEX").when(size > total * 0.03, "Medium GEX").otherwise("Low GEX"),
        "gex_concentration_pct": safe_div(size, total) * 100,
        "has_pin_risk": (F.col("net_dealer_gex") > total * 0.15) & (F.col("days_to_expiry") <= 7),
        "hedging": F.when(sign > 0, "Stabilizing").when(sign < 0, "Amplifying").otherwise("Neutral"),
        "gamma_regime": F.when(spot > flip, "Above Flip (Negative GEX Zone)").when(spot < flip, "Below Flip (Positive GEX Zone)").when(flip.isNotNull(), "At Flip Level"),
        "gex_key": F.concat_ws("_", "week_ending", "ticker", F.format_string("%.2f", "strike"), "expiry_date"),
    })


WEEKLY_SQL = f"""
WITH {adapters.oracle("option_chain")},
weeks AS (
  SELECT *, trade_date + CAST(5 - dayofweek(trade_date) AS INTEGER) AS week_ending FROM option_chain WHERE open_interest > 0 AND gamma > 0 AND underlying_price > 0 AND dayofweek(trade_date) IN (4, 5, 6)),
one AS (SELECT * FROM weeks QUALIFY row_number() OVER (PARTITION BY week_ending, ticker, option_type, strike, expiry_date ORDER BY trade_date DESC) = 1),
g AS (SELECT *, open_interest * gamma * 100 * underlying_price * underlying_price AS gross, CASE option_type WHEN 'Call' THEN -1 ELSE 1 END AS side,
        CASE WHEN days_to_expiry <= 7 THEN 2.0 WHEN days_to_expiry <= 30 THEN 1.5 WHEN days_to_expiry <= 60 THEN 1.0 WHEN days_to_expiry <= 120 THEN 0.6 ELSE 0.3 END AS weight FROM one),
k AS (
  SELECT week_ending, ticker, expiry_date, strike, max(trade_date) AS friday_trade_date, avg(underlying_price) AS underlying_price, max(days_to_expiry) AS days_to_expiry,
         CAST(coalesce(sum(open_interest) FILTER (side = -1), 0) AS BIGINT) AS call_oi, CAST(coalesce(sum(open_interest) FILTER (side = 1), 0) AS BIGINT) AS put_oi,
         sum(gross * side) AS net_dealer_gex, sum(gross * side * weight) AS time_weighted_gex, sum(gross) AS total_gross_gex, sum(open_interest * last_price * 100) AS total_notional_eur,
         avg(implied_volatility) FILTER (side = -1) AS call_iv, avg(implied_volatility) FILTER (side = 1) AS put_iv
  FROM g GROUP BY week_ending, ticker, expiry_date, strike),
flip AS (
  SELECT DISTINCT ON (a.week_ending, a.ticker, a.expiry_date) a.week_ending, a.ticker, a.expiry_date, a.strike AS gamma_flip_strike
  FROM k a CROSS JOIN LATERAL (SELECT b.net_dealer_gex FROM k b WHERE b.week_ending = a.week_ending AND b.ticker = a.ticker AND b.expiry_date = a.expiry_date AND b.strike <> a.strike
                               ORDER BY round(abs(b.strike - b.underlying_price), 6), b.strike LIMIT 1) n
  WHERE sign(a.net_dealer_gex) <> sign(n.net_dealer_gex)
  ORDER BY a.week_ending, a.ticker, a.expiry_date, round(abs(a.strike - a.underlying_price), 6), a.strike),
t AS (
  SELECT k.*, f.gamma_flip_strike, sum(abs(net_dealer_gex)) OVER e AS expiry_gex, sum(net_dealer_gex) OVER e AS expiry_net_gex, sum(net_dealer_gex) OVER (PARTITION BY k.week_ending, k.ticker) AS portfolio_net_gex,
         row_number() OVER (PARTITION BY k.week_ending, k.ticker, k.expiry_date ORDER BY round(abs(net_dealer_gex), 6) DESC, strike) AS gex_rank
  FROM k LEFT JOIN flip f USING (week_ending, ticker, expiry_date) WINDOW e AS (PARTITION BY k.week_ending, k.ticker, k.expiry_date))
SELECT concat(week_ending, '_', ticker, '_', format('{{:.2f}}', strike), '_', expiry_date) AS gex_key, week_ending, friday_trade_date, ticker, strike, expiry_date, days_to_expiry, round(underlying_price, 4) AS underlying_price,
       call_oi, put_oi, round(net_dealer_gex, 0) AS net_dealer_gex, round(time_weighted_gex, 0) AS time_weighted_gex, round(total_gross_gex, 0) AS total_gross_gex, round(total_notional_eur, 0) AS total_notional_eur,
       round(call_iv, 4) AS call_iv, round(put_iv, 4) AS put_iv, round(expiry_net_gex, 0) AS expiry_net_gex, round(portfolio_net_gex, 0) AS portfolio_net_gex, CAST(gex_rank AS BIGINT) AS gex_rank,
       round(abs(net_dealer_gex) / nullif(expiry_gex, 0) * 100, 2) AS gex_concentration_pct, gamma_flip_strike,
       CASE WHEN abs(net_dealer_gex) > expiry_gex * 0.2 THEN 'Gamma Wall' WHEN abs(net_dealer_gex) > expiry_gex * 0.1 THEN 'High GEX' WHEN abs(net_dealer_gex) > expiry_gex * 0.03 THEN 'Medium GEX' ELSE 'Low GEX' END AS gex_tier,
       net_dealer_gex > expiry_gex * 0.15 AND days_to_expiry <= 7 AS has_pin_risk, CASE WHEN net_dealer_gex > 0 THEN 'Stabilizing' WHEN net_dealer_gex < 0 THEN 'Amplifying' ELSE 'Neutral' END AS hedging,
       CASE WHEN underlying_price > gamma_flip_strike THEN 'Above Flip (Negative GEX Zone)' WHEN underlying_price < gamma_flip_strike THEN 'Below Flip (Positive GEX Zone)' WHEN gamma_flip_strike IS NOT NULL THEN 'At Flip Level' END AS gamma_regime
FROM t WHERE gex_rank <= 50
"""


@register("gamma_exposure_weekly", WEEKLY_SQL)
def weekly_query(spark, sf_dir):
    out = weekly_exposure(adapters.load(spark, sf_dir, "option_chain"))
    return out.select(
        "gex_key", "week_ending", "friday_trade_date", "ticker", "strike", "expiry_date", "days_to_expiry", r("underlying_price").alias("underlying_price"), "call_oi", "put_oi",
        *[r(c, 0).alias(c) for c in ("net_dealer_gex", "time_weighted_gex", "total_gross_gex", "total_notional_eur", "expiry_net_gex", "portfolio_net_gex")],
        r("call_iv").alias("call_iv"), r("put_iv").alias("put_iv"), "gex_rank", r("gex_concentration_pct", 2).alias("gex_concentration_pct"), "gamma_flip_strike", "gex_tier", "has_pin_risk", "hedging", "gamma_regime",
    )


# Max pain


def pain_by_strike(chain: DataFrame) -> DataFrame:
    """Value of all calls and puts if the underlying ends at each strike. Sorted by strike, the value of calls at K is
    K * OI(<= K) - sum(strike * OI)(<= K), and for puts mirrored, so two running sums replace the join of strikes with strikes."""
    some = chain.where(F.col("greeks_valid") & (F.col("open_interest") > 0) & (F.col("strike") > 0))
    call = F.col("option_type") == "Call"
    oi = F.col("open_interest").cast("double")
    per = some.groupBy(*EXPIRY, "strike").agg(
        F.max("underlying_price").alias("underlying_price"), F.max("days_to_expiry").alias("days_to_expiry"), sum_if(call, oi).cast("double").alias("c"), sum_if(~call, oi).cast("double").alias("p")
    )
    w = Window.partitionBy(*EXPIRY).orderBy("strike")
    below, above = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*EXPIRY)
    k = F.col("strike")
    return per.withColumns({
        "call_value": k * F.sum("c").over(below) - F.sum(k * F.col("c")).over(below),
        "put_value": F.sum(k * F.col("p")).over(above) - k * F.sum("p").over(above),
        "total_call_oi": F.sum("c").over(whole).cast("long"),
        "total_put_oi": F.sum("p").over(whole).cast("long"),
    }).withColumn("total_value", F.col("call_value") + F.col("put_value"))


def max_pain(chain: DataFrame) -> DataFrame:
    rows = pain_by_strike(chain)
    gap = F.round(F.abs(F.col("strike") - F.col("underlying_price")), 6)
    best = F.struct("total_value", gap.alias("gap"), "strike", "call_value", "put_value")
    out = rows.groupBy(*EXPIRY).agg(
        F.max("underlying_price").alias("underlying_price"), F.max("days_to_expiry").alias("days_to_expiry"), F.min(best).alias("best"), F.min_by("total_value", F.struct(gap, "strike")).alias("current_total_value"),
        F.max("total_value").alias("max_total_value"), F.max("total_call_oi").alias("total_call_oi"), F.max("total_put_oi").alias("total_put_oi"),
    )
    spot, pain = F.col("underlying_price"), F.col("best.strike")
    pct = safe_div(F.abs(pain - spot), spot)
    days = F.col("days_to_expiry")
    return out.select(
        *EXPIRY, "underlying_price", "days_to_expiry", pain.alias("max_pain_strike"), (safe_div(pain - spot, spot) * 100).alias("max_pain_distance_pct"), F.col("best.total_value").alias("min_total_value"), "current_total_value",
        "max_total_value", (F.col("current_total_value") - F.col("best.total_value")).alias("potential_loss_to_holders"), F.col("best.call_value").alias("max_pain_call_value"), F.col("best.put_value").alias("max_pain_put_value"),
        (F.col("total_call_oi") + F.col("total_put_oi")).alias("total_oi"), "total_call_oi", "total_put_oi", safe_div(F.col("total_put_oi"), F.col("total_call_oi")).alias("put_call_oi_ratio"),
        (safe_div(F.col("max_total_value") - F.col("best.total_value"), F.col("best.total_value")) * 100).alias("pain_range_pct"),
        F.when((days <= 3) & (pct < 0.02), "High Pin Risk").when((days <= 7) & (pct < 0.05), "Moderate Pin Risk").otherwise("Low Pin Risk").alias("pin_risk_level"),
        F.when(days == 0, "Expiration Day").otherwise(steps(days, [(3, "Week of Expiry"), (7, "Within 1 Week"), (14, "Within 2 Weeks"), (30, "Within 1 Month")], "More than 1 Month")).alias("time_to_expiry_bucket"),
        (F.abs(pain - spot) < spot * 0.01).alias("is_near_max_pain"), (pain > spot).alias("max_pain_above_price"),
    )


PAIN_CTE = """
pain AS (
  SELECT ticker, trade_date, expiry_date, underlying_price, days_to_expiry, option_type, strike, open_interest FROM option_chain WHERE greeks_valid AND open_interest > 0 AND strike > 0),
spots AS (SELECT DISTINCT ticker, trade_date, expiry_date, underlying_price, days_to_expiry, strike AS k FROM pain),
vals AS (
  SELECT s.ticker, s.trade_date, s.expiry_date, s.underlying_price, s.days_to_expiry, s.k,
         CAST(sum(CASE WHEN option_type = 'Call' THEN greatest(0, s.k - p.strike) * p.open_interest ELSE 0 END) AS DOUBLE) AS cv, CAST(sum(CASE WHEN option_type = 'Put' THEN greatest(0, p.strike - s.k) * p.open_interest ELSE 0 END) AS DOUBLE) AS pv,
         CAST(sum(CASE WHEN option_type = 'Call' THEN open_interest ELSE 0 END) AS BIGINT) AS coi, CAST(sum(CASE WHEN option_type = 'Put' THEN open_interest ELSE 0 END) AS BIGINT) AS poi
  FROM spots s JOIN pain p USING (ticker, trade_date, expiry_date) GROUP BY ALL),
ranked AS (
  SELECT *, cv + pv AS tv, row_number() OVER (PARTITION BY ticker, trade_date, expiry_date ORDER BY cv + pv, round(abs(k - underlying_price), 6), k) AS r,
         first_value(cv + pv) OVER (PARTITION BY ticker, trade_date, expiry_date ORDER BY round(abs(k - underlying_price), 6), k) AS current_total_value,
         max(cv + pv) OVER (PARTITION BY ticker, trade_date, expiry_date) AS max_total_value FROM vals),
max_pain AS (
  SELECT ticker, trade_date, expiry_date, underlying_price, days_to_expiry, k AS max_pain_strike, (k - underlying_price) / underlying_price * 100 AS max_pain_distance_pct, tv AS min_total_value, current_total_value, max_total_value,
         current_total_value - tv AS potential_loss_to_holders, cv AS max_pain_call_value, pv AS max_pain_put_value, coi + poi AS total_oi, coi AS total_call_oi, poi AS total_put_oi, CAST(poi AS DOUBLE) / nullif(coi, 0) AS put_call_oi_ratio,
         (max_total_value - tv) / nullif(tv, 0) * 100 AS pain_range_pct,
         CASE WHEN days_to_expiry <= 3 AND abs(k - underlying_price) / underlying_price < 0.02 THEN 'High Pin Risk' WHEN days_to_expiry <= 7 AND abs(k - underlying_price) / underlying_price < 0.05 THEN 'Moderate Pin Risk' ELSE 'Low Pin Risk' END AS pin_risk_level,
         CASE WHEN days_to_expiry = 0 THEN 'Expiration Day' WHEN days_to_expiry <= 3 THEN 'Week of Expiry' WHEN days_to_expiry <= 7 THEN 'Within 1 Week' WHEN days_to_expiry <= 14 THEN 'Within 2 Weeks' WHEN days_to_expiry <= 30 THEN 'Within 1 Month' ELSE 'More than 1 Month' END AS time_to_expiry_bucket,
         abs(k - underlying_price) < underlying_price * 0.01 AS is_near_max_pain, k > underlying_price AS max_pain_above_price
  FROM ranked WHERE r = 1)"""
PAIN_ROUND = {"max_pain_distance_pct": 6, "put_call_oi_ratio": 6, "pain_range_pct": 4}
PAIN_COLUMNS = "ticker trade_date expiry_date underlying_price days_to_expiry max_pain_strike max_pain_distance_pct min_total_value current_total_value max_total_value potential_loss_to_holders max_pain_call_value max_pain_put_value total_oi total_call_oi total_put_oi put_call_oi_ratio pain_range_pct pin_risk_level time_to_expiry_bucket is_near_max_pain max_pain_above_price".split()


@register("max_pain", f"WITH {adapters.oracle('option_chain')},{PAIN_CTE} SELECT " + ", ".join(f"round({c}, {PAIN_ROUND[c]}) AS {c}" if c in PAIN_ROUND else c for c in PAIN_COLUMNS) + " FROM max_pain")
def max_pain_query(spark, sf_dir):
    out = max_pain(adapters.load(spark, sf_dir, "option_chain"))
    return out.select(*[r(c, PAIN_ROUND[c]).alias(c) if c in PAIN_ROUND else c for c in PAIN_COLUMNS])


# Key levels


def key_levels(chain: DataFrame) -> DataFrame:
    """Walls, zero-gamma strike, max pain, open-interest and vega concentrations of each expiry in one row."""
    g = gamma_exposure(chain)
    g = ranked(g, EXPIRY, [F.desc("total_oi"), F.asc("strike")], "oi_rank")
    g = ranked(g, EXPIRY, [F.desc(F.round(F.abs("net_vega_exposure"), 6)), F.asc("strike")], "vega_rank")
    at = lambda rank, n, c: F.max(F.when(F.col(rank) == n, F.col(c)))
    levels = g.groupBy(*EXPIRY, "underlying_price", "days_to_expiry").agg(
        *[at("gex_rank", n, "strike").alias(f"resistance_{n}") for n in (1, 2, 3)],
        *[at("gex_rank", n, "net_dealer_gex").alias(f"resistance_{n}_strength") for n in (1, 2, 3)],
        F.min(F.when(F.abs("net_dealer_gex") < F.col("expiry_total_gex") * 0.05, F.col("strike"))).alias("gex_flip_level"),
        *[at("oi_rank", n, "strike").alias(f"key_oi_level_{n}") for n in (1, 2, 3)],
        at("oi_rank", 1, "total_oi").alias("key_oi_level_1_contracts"),
        *[at("vega_rank", n, "strike").alias(f"vanna_trigger_{n}") for n in (1, 2)],
        F.max(F.when(F.col("call_dealer_gex") < 0, F.col("strike"))).alias("call_wall"),
        F.min("call_dealer_gex").alias("call_wall_strength"),
        F.max(F.when(F.col("put_dealer_gex") > 0, F.col("strike"))).alias("put_wall"),
        F.max("put_dealer_gex").alias("put_wall_strength"),
        F.sum("net_dealer_gex").alias("total_net_gex"),
        F.sum(F.abs("net_dealer_gex")).alias("total_abs_gex"),
    )
    pain = max_pain(chain).select(*EXPIRY, "max_pain_strike", "pin_risk_level", "total_oi", "put_call_oi_ratio")
    spot, flip, wall, ratio = (F.col(c) for c in ("underlying_price", "gex_flip_level", "resistance_1", "put_call_oi_ratio"))
    near = lambda level: F.coalesce(spot.between(level * 0.99, level * 1.01), F.lit(False))
    return levels.join(pain, EXPIRY, "left").withColumns({
        "current_gex_zone": F.when(spot > flip, "Positive GEX Zone").when(spot < flip, "Negative GEX Zone").otherwise("At Zero Gamma"),
        "market_regime": F.when(F.col("total_net_gex") > 0, "Dealer Long Gamma (Stabilizing)").when(F.col("total_net_gex") < 0, "Dealer Short Gamma (Volatility Amplifying)").otherwise("Neutral"),
        "sentiment_from_oi": F.when(ratio > 1.5, "Very Bearish").when(ratio > 1.0, "Bearish").when(ratio < 0.7, "Bullish").otherwise("Neutral"),
        "high_pin_probability": F.coalesce((safe_div(F.abs(F.col("max_pain_strike") - spot), spot) < 0.02) & (F.col("days_to_expiry") <= 3), F.lit(False)),
        "at_gamma_wall": near(wall),
        "at_gex_flip": near(flip),
    })


LEVEL_ROUND = {"resistance_1_strength": 2, "resistance_2_strength": 2, "resistance_3_strength": 2, "call_wall_strength": 2, "put_wall_strength": 2, "total_net_gex": 2, "total_abs_gex": 2, "put_call_oi_ratio": 6}
LEVEL_COLUMNS = (
    EXPIRY + ["underlying_price", "days_to_expiry", *[f"resistance_{n}{s}" for n in (1, 2, 3) for s in ("", "_strength")], "gex_flip_level", "key_oi_level_1", "key_oi_level_2", "key_oi_level_3", "key_oi_level_1_contracts", "vanna_trigger_1", "vanna_trigger_2"]
    + ["call_wall", "call_wall_strength", "put_wall", "put_wall_strength", "total_net_gex", "total_abs_gex", "max_pain_strike", "pin_risk_level", "total_oi", "put_call_oi_ratio", "current_gex_zone", "market_regime", "sentiment_from_oi"]
    + ["high_pin_probability", "at_gamma_wall", "at_gex_flip"]
)
LEVELS_SQL = f"""
WITH {adapters.oracle("option_chain")},{WEEK_LAST_SQL},{PAIN_CTE},
lr AS (SELECT *, row_number() OVER (PARTITION BY ticker, trade_date, expiry_date ORDER BY total_oi DESC, strike) AS oi_rank,
              row_number() OVER (PARTITION BY ticker, trade_date, expiry_date ORDER BY round(abs(net_vega_exposure), 6) DESC, strike) AS vega_rank FROM gex_named),
lv AS (
  SELECT ticker, trade_date, expiry_date, underlying_price, days_to_expiry,
         {", ".join(f"max(strike) FILTER (gex_rank = {n}) AS resistance_{n}, max(net_dealer_gex) FILTER (gex_rank = {n}) AS resistance_{n}_strength, max(strike) FILTER (oi_rank = {n}) AS key_oi_level_{n}" for n in (1, 2, 3))},
         min(strike) FILTER (abs(net_dealer_gex) < expiry_total_gex * 0.05) AS gex_flip_level, max(total_oi) FILTER (oi_rank = 1) AS key_oi_level_1_contracts,
         max(strike) FILTER (vega_rank = 1) AS vanna_trigger_1, max(strike) FILTER (vega_rank = 2) AS vanna_trigger_2, max(strike) FILTER (call_dealer_gex < 0) AS call_wall, min(call_dealer_gex) AS call_wall_strength,
         max(strike) FILTER (put_dealer_gex > 0) AS put_wall, max(put_dealer_gex) AS put_wall_strength, sum(net_dealer_gex) AS total_net_gex, sum(abs(net_dealer_gex)) AS total_abs_gex
  FROM lr GROUP BY ticker, trade_date, expiry_date, underlying_price, days_to_expiry),
lj AS (
  SELECT lv.*, m.max_pain_strike, m.pin_risk_level, m.total_oi, m.put_call_oi_ratio,
         CASE WHEN lv.underlying_price > gex_flip_level THEN 'Positive GEX Zone' WHEN lv.underlying_price < gex_flip_level THEN 'Negative GEX Zone' ELSE 'At Zero Gamma' END AS current_gex_zone,
         CASE WHEN total_net_gex > 0 THEN 'Dealer Long Gamma (Stabilizing)' WHEN total_net_gex < 0 THEN 'Dealer Short Gamma (Volatility Amplifying)' ELSE 'Neutral' END AS market_regime,
         CASE WHEN m.put_call_oi_ratio > 1.5 THEN 'Very Bearish' WHEN m.put_call_oi_ratio > 1 THEN 'Bearish' WHEN m.put_call_oi_ratio < 0.7 THEN 'Bullish' ELSE 'Neutral' END AS sentiment_from_oi,
         coalesce(abs(m.max_pain_strike - lv.underlying_price) / lv.underlying_price < 0.02 AND lv.days_to_expiry <= 3, false) AS high_pin_probability,
         coalesce(lv.underlying_price BETWEEN resistance_1 * 0.99 AND resistance_1 * 1.01, false) AS at_gamma_wall, coalesce(lv.underlying_price BETWEEN gex_flip_level * 0.99 AND gex_flip_level * 1.01, false) AS at_gex_flip
  FROM lv LEFT JOIN max_pain m USING (ticker, trade_date, expiry_date))
SELECT {", ".join(f"round({c}, {LEVEL_ROUND[c]}) AS {c}" if c in LEVEL_ROUND else c for c in LEVEL_COLUMNS)} FROM lj
"""


@register("key_levels", LEVELS_SQL)
def key_levels_query(spark, sf_dir):
    out = key_levels(adapters.load(spark, sf_dir, "option_chain"))
    return out.select(*[r(c, LEVEL_ROUND[c]).alias(c) if c in LEVEL_ROUND else c for c in LEVEL_COLUMNS])
