"""Week-over-week positioning on top of weekly gamma exposure: strike roles, flows, and hold, break and buyer scores.

Every key carries the ticker. "Previous week" is the previous week that has the contract. Changes of volatility are rounded to
nine digits, so that a change of nothing is no change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import clamp, safe_div
from tidemark.operators.series import series
from tidemark.plans.gold_chain import chain_of, select_rounded, sql_rounded
from tidemark.plans.gold_gamma import WEEKLY_SQL, weekly_exposure
from tidemark.plans.registry import register

# The bands of a strike's role.
STRONG, SOME = 50_000_000, 20_000_000


def realised(chain: DataFrame) -> DataFrame:
    """Volatility of the last ten and twenty spot changes, and the move over five rows, per ticker and day."""
    spot = chain.groupBy("ticker", "trade_date").agg(F.max("underlying_price").alias("spot"))
    w = series("ticker", "trade_date")
    rows = spot.withColumn("ret", F.log(F.col("spot") / F.lag("spot").over(w)))
    vol = lambda n: F.stddev_samp("ret").over(w.rowsBetween(-(n - 1), 0)) * F.sqrt(F.lit(252.0))
    return rows.select("ticker", "trade_date", vol(10).alias("rv_10d"), vol(20).alias("rv_20d"), (safe_div(F.col("spot") - F.lag("spot", 5).over(w), F.lag("spot", 5).over(w)) * 100).alias("trend_5d"))


def flow(oi: Column, iv: Column) -> Column:
    return F.when((oi > 0) & (iv > 0), "Buyer Driven").when((oi > 0) & (iv < 0), "Seller Driven").when((oi < 0) & (iv > 0), "Closing Shorts (Demand)").when((oi < 0) & (iv < 0), "Closing Longs (Supply)").when((oi > 0) & (iv == 0), "Neutral Flow")


def leading(side: str, oi: Column, iv: Column) -> Column:
    return F.when((oi > 0) & (iv > 0), f"{side} Buying").when((oi > 0) & (iv < 0), f"{side} Selling").otherwise(f"{side} Closing")


def positioning_trends(chain: DataFrame) -> DataFrame:
    week = Window.partitionBy("ticker", "week_ending")
    key = Window.partitionBy("ticker", "strike", "expiry_date").orderBy("week_ending")
    expiry = Window.partitionBy("ticker", "week_ending", "expiry_date")
    gex = F.col("net_dealer_gex")
    df = weekly_exposure(chain).join(realised(chain).withColumnRenamed("trade_date", "friday_trade_date"), ["ticker", "friday_trade_date"], "left")
    role = F.when(gex > STRONG, "Strong Support").when(gex > SOME, "Support").when(gex >= -SOME, "Flip Point").when(gex < -STRONG, "Strong Resistance").otherwise("Resistance")
    df = df.withColumns({"strike_role": role, "put_call_ratio": F.when(F.col("call_oi") > 0, F.col("put_oi") / F.col("call_oi")), "iv_atm": F.min_by("avg_iv", F.struct("gap", "strike")).over(expiry)})
    was = lambda c: F.lag(c).over(key)
    moved = lambda c: F.col(c) - was(c)
    df = df.withColumns({
        "prev_strike_role": was("strike_role"), "call_oi_change": moved("call_oi"), "put_oi_change": moved("put_oi"), "call_iv_change": F.round(moved("call_iv"), 9), "put_iv_change": F.round(moved("put_iv"), 9), "avg_iv_change": F.round(moved("avg_iv"), 9),
        "call_oi_pct_change": F.when(was("call_oi") > 0, moved("call_oi") / was("call_oi") * 100), "put_oi_pct_change": F.when(was("put_oi") > 0, moved("put_oi") / was("put_oi") * 100), "net_gex_pct_change": safe_div(moved("net_dealer_gex"), F.abs(was("net_dealer_gex"))) * 100,
        "gex_place": F.row_number().over(expiry.orderBy(F.desc(F.round(gex, 6)), "strike")),
    })
    c, p, ci, pi, ai = (F.col(x) for x in ("call_oi_change", "put_oi_change", "call_iv_change", "put_iv_change", "avg_iv_change"))
    df = df.withColumns({
        "role_shifted": F.coalesce(F.col("strike_role") != F.col("prev_strike_role"), F.lit(False)), "call_flow_type": flow(c, ci), "put_flow_type": flow(p, pi),
        "conviction_trend": F.when((F.col("call_oi_pct_change") > 20) | (F.col("put_oi_pct_change") > 20), "Building").when((F.col("call_oi_pct_change") < -20) | (F.col("put_oi_pct_change") < -20), "Unwinding").otherwise("Stable"),
        "gex_trend": F.when(F.col("net_gex_pct_change") > 50, "Accelerating").when(F.col("net_gex_pct_change") < -50, "Weakening").otherwise("Steady"),
        "dominant_flow": F.when(F.abs(c) > F.abs(p), leading("Call", c, ci)).when(F.abs(p) > F.abs(c), leading("Put", p, pi)).otherwise("Balanced"), "is_gamma_wall": (F.col("gex_place") == 1) & (gex > 0),
    })
    dom, cf, pf, pcr = F.col("dominant_flow"), F.col("call_flow_type"), F.col("put_flow_type"), F.col("put_call_ratio")
    iv, zero = F.coalesce("iv_atm", "avg_iv"), F.lit(0.0)
    trend, swing = F.abs(F.coalesce("trend_5d", zero)), F.abs(F.coalesce("net_gex_pct_change", zero))
    rv10, rv20 = F.coalesce("rv_10d", zero), F.coalesce("rv_20d", zero)
    on = lambda cond, n: F.when(cond, n).otherwise(0)
    hold = (
        50 + on(gex > 0, F.least(F.lit(25.0), gex / 2_000_000)) + on(pcr > 1.5, 10) + on(F.col("strike_role").isin("Strong Support", "Support"), 10) + on(trend < 2, 5) + on(rv10 < iv * 0.8, 3) + on(rv20 < iv * 0.8, 2)
        - on(swing > 30, 15) - on(dom.like("%Closing%"), 10) - on(F.col("days_to_expiry") < 7, 10)
    )
    brk = (
        50 + on(gex < 0, F.least(F.lit(25.0), -gex / 2_000_000)) + on(F.col("strike_role").isin("Strong Resistance", "Resistance"), 10) + on(trend > 5, 15) + on(rv10 > iv * 1.2, 6) + on(rv20 > iv * 1.1, 4) + on(dom.isin("Call Buying", "Put Buying"), 10)
        + on(swing > 30, 10) - on(gex > 0, F.least(F.lit(20.0), gex / 2_500_000)) - on((pcr > 1.5) & (gex > 0), 10) - on(F.col("is_gamma_wall"), 15)
    )
    either = lambda kind, n: F.when((cf == kind) | (pf == kind), n).otherwise(0)
    buyer = (
        50 + F.when(dom.like("%Buying"), 20).otherwise(either("Buyer Driven", 10)) - F.when(dom.like("%Selling"), 20).otherwise(either("Seller Driven", 10)) + either("Closing Shorts (Demand)", 5) - either("Closing Longs (Supply)", 5)
        + F.when((c > 0) & (p > 0) & (ai > 0), 5).when((c > 0) & (p > 0) & (ai < 0), -5).otherwise(0)
    )
    df = df.withColumns({"hold_bias_score": clamp(F.round(hold, 6), 0.0, 100.0), "break_bias_score": clamp(F.round(brk, 6), 0.0, 100.0), "buyer_flow_bias": F.least(F.greatest(buyer, F.lit(0)), F.lit(100)).cast("long")})
    for name in ("hold", "break"):
        x = F.col(f"{name}_bias_score")
        sd = F.stddev_samp(x).over(week)
        df = df.withColumns({f"{name}_bias_z_week": F.when(F.round(sd, 9) > 0, (x - F.avg(x).over(week)) / sd), f"{name}_bias_percentile_week": (F.ntile(100).over(week.orderBy(x, "strike", "expiry_date")) - 1).cast("long")})
    return df


TRENDS = {"week_ending": None, "ticker": None, "strike": None, "expiry_date": None, "strike_role": None, "put_call_ratio": 6, "iv_atm": 6, "rv_10d": 6, "rv_20d": 6, "trend_5d": 6, "call_oi_change": None, "put_oi_change": None, "avg_iv_change": 6, "net_gex_pct_change": 4} | dict.fromkeys(
    ["role_shifted", "call_flow_type", "put_flow_type", "conviction_trend", "gex_trend", "dominant_flow", "is_gamma_wall", "buyer_flow_bias", "hold_bias_percentile_week", "break_bias_percentile_week"]
) | {"hold_bias_score": 4, "break_bias_score": 4, "hold_bias_z_week": 4, "break_bias_z_week": 4}


def _flow(s: str) -> str:
    o, i = f"{s}_oi_change", f"{s}_iv_change"
    return f"CASE WHEN {o} > 0 AND {i} > 0 THEN 'Buyer Driven' WHEN {o} > 0 AND {i} < 0 THEN 'Seller Driven' WHEN {o} < 0 AND {i} > 0 THEN 'Closing Shorts (Demand)' WHEN {o} < 0 AND {i} < 0 THEN 'Closing Longs (Supply)' WHEN {o} > 0 AND {i} = 0 THEN 'Neutral Flow' END"


def _lead(s: str) -> str:
    o, i = f"{s}_oi_change", f"{s}_iv_change"
    return f"CASE WHEN {o} > 0 AND {i} > 0 THEN '{s.title()} Buying' WHEN {o} > 0 AND {i} < 0 THEN '{s.title()} Selling' ELSE '{s.title()} Closing' END"


def _either(kind: str, n: int) -> str:
    return f"CASE WHEN coalesce(call_flow_type = '{kind}', false) OR coalesce(put_flow_type = '{kind}', false) THEN {n} ELSE 0 END"


TRENDS_SQL = f"""
{WEEKLY_SQL.split("SELECT concat(week_ending")[0].rstrip()},
sp AS (SELECT ticker, trade_date, max(underlying_price) AS spot FROM option_chain GROUP BY 1, 2),
sr AS (SELECT *, ln(spot / lag(spot) OVER w) AS ret, lag(spot, 5) OVER w AS s5 FROM sp WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
rv AS (SELECT ticker, trade_date AS friday_trade_date, CASE WHEN count(ret) OVER a > 1 THEN stddev_samp(ret) OVER a END * sqrt(252) AS rv_10d, CASE WHEN count(ret) OVER b > 1 THEN stddev_samp(ret) OVER b END * sqrt(252) AS rv_20d, (spot - s5) / nullif(s5, 0) * 100 AS trend_5d FROM sr
       WINDOW a AS (PARTITION BY ticker ORDER BY trade_date ROWS 9 PRECEDING), b AS (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING)),
av AS (SELECT week_ending, ticker, expiry_date, strike, avg(implied_volatility) AS avg_iv FROM g GROUP BY 1, 2, 3, 4),
p0 AS (SELECT t.*, av.avg_iv, rv_10d, rv_20d, trend_5d, CASE WHEN call_oi > 0 THEN put_oi / call_oi END AS put_call_ratio,
         CASE WHEN net_dealer_gex > {STRONG} THEN 'Strong Support' WHEN net_dealer_gex > {SOME} THEN 'Support' WHEN net_dealer_gex >= -{SOME} THEN 'Flip Point' WHEN net_dealer_gex < -{STRONG} THEN 'Strong Resistance' ELSE 'Resistance' END AS strike_role,
         first_value(av.avg_iv) OVER (PARTITION BY t.ticker, t.week_ending, t.expiry_date ORDER BY round(abs(t.strike - t.underlying_price), 6), t.strike) AS iv_atm
       FROM t JOIN av USING (week_ending, ticker, expiry_date, strike) LEFT JOIN rv USING (ticker, friday_trade_date) WHERE gex_rank <= 50),
p1 AS (SELECT *, lag(strike_role) OVER k AS prev_strike_role, call_oi - lag(call_oi) OVER k AS call_oi_change, put_oi - lag(put_oi) OVER k AS put_oi_change, round(call_iv - lag(call_iv) OVER k, 9) AS call_iv_change, round(put_iv - lag(put_iv) OVER k, 9) AS put_iv_change,
         round(avg_iv - lag(avg_iv) OVER k, 9) AS avg_iv_change, CASE WHEN lag(call_oi) OVER k > 0 THEN (call_oi - lag(call_oi) OVER k) / lag(call_oi) OVER k * 100 END AS call_oi_pct_change,
         CASE WHEN lag(put_oi) OVER k > 0 THEN (put_oi - lag(put_oi) OVER k) / lag(put_oi) OVER k * 100 END AS put_oi_pct_change, (net_dealer_gex - lag(net_dealer_gex) OVER k) / nullif(abs(lag(net_dealer_gex) OVER k), 0) * 100 AS net_gex_pct_change,
         row_number() OVER (PARTITION BY ticker, week_ending, expiry_date ORDER BY round(net_dealer_gex, 6) DESC, strike) AS gex_place FROM p0 WINDOW k AS (PARTITION BY ticker, strike, expiry_date ORDER BY week_ending)),
p2 AS (SELECT *, coalesce(strike_role <> prev_strike_role, false) AS role_shifted, {_flow("call")} AS call_flow_type, {_flow("put")} AS put_flow_type,
         CASE WHEN call_oi_pct_change > 20 OR put_oi_pct_change > 20 THEN 'Building' WHEN call_oi_pct_change < -20 OR put_oi_pct_change < -20 THEN 'Unwinding' ELSE 'Stable' END AS conviction_trend,
         CASE WHEN net_gex_pct_change > 50 THEN 'Accelerating' WHEN net_gex_pct_change < -50 THEN 'Weakening' ELSE 'Steady' END AS gex_trend,
         CASE WHEN abs(call_oi_change) > abs(put_oi_change) THEN {_lead("call")} WHEN abs(put_oi_change) > abs(call_oi_change) THEN {_lead("put")} ELSE 'Balanced' END AS dominant_flow, gex_place = 1 AND net_dealer_gex > 0 AS is_gamma_wall, coalesce(iv_atm, avg_iv) AS ivx FROM p1),
p3 AS (SELECT *, least(greatest(round(50 + CASE WHEN net_dealer_gex > 0 THEN least(25, net_dealer_gex / 2000000) ELSE 0 END + CASE WHEN put_call_ratio > 1.5 THEN 10 ELSE 0 END + CASE WHEN strike_role IN ('Strong Support', 'Support') THEN 10 ELSE 0 END + CASE WHEN abs(coalesce(trend_5d, 0)) < 2 THEN 5 ELSE 0 END
           + CASE WHEN coalesce(rv_10d, 0) < ivx * 0.8 THEN 3 ELSE 0 END + CASE WHEN coalesce(rv_20d, 0) < ivx * 0.8 THEN 2 ELSE 0 END - CASE WHEN abs(coalesce(net_gex_pct_change, 0)) > 30 THEN 15 ELSE 0 END - CASE WHEN dominant_flow LIKE '%Closing%' THEN 10 ELSE 0 END
           - CASE WHEN days_to_expiry < 7 THEN 10 ELSE 0 END, 6), 0), 100) AS hold_bias_score,
         least(greatest(round(50 + CASE WHEN net_dealer_gex < 0 THEN least(25, -net_dealer_gex / 2000000) ELSE 0 END + CASE WHEN strike_role IN ('Strong Resistance', 'Resistance') THEN 10 ELSE 0 END + CASE WHEN abs(coalesce(trend_5d, 0)) > 5 THEN 15 ELSE 0 END
           + CASE WHEN coalesce(rv_10d, 0) > ivx * 1.2 THEN 6 ELSE 0 END + CASE WHEN coalesce(rv_20d, 0) > ivx * 1.1 THEN 4 ELSE 0 END + CASE WHEN dominant_flow IN ('Call Buying', 'Put Buying') THEN 10 ELSE 0 END + CASE WHEN abs(coalesce(net_gex_pct_change, 0)) > 30 THEN 10 ELSE 0 END
           - CASE WHEN net_dealer_gex > 0 THEN least(20, net_dealer_gex / 2500000) ELSE 0 END - CASE WHEN put_call_ratio > 1.5 AND net_dealer_gex > 0 THEN 10 ELSE 0 END - CASE WHEN is_gamma_wall THEN 15 ELSE 0 END, 6), 0), 100) AS break_bias_score,
         CAST(least(greatest(50 + CASE WHEN dominant_flow LIKE '%Buying' THEN 20 ELSE {_either("Buyer Driven", 10)} END - CASE WHEN dominant_flow LIKE '%Selling' THEN 20 ELSE {_either("Seller Driven", 10)} END + {_either("Closing Shorts (Demand)", 5)} - {_either("Closing Longs (Supply)", 5)}
           + CASE WHEN call_oi_change > 0 AND put_oi_change > 0 AND avg_iv_change > 0 THEN 5 WHEN call_oi_change > 0 AND put_oi_change > 0 AND avg_iv_change < 0 THEN -5 ELSE 0 END, 0), 100) AS BIGINT) AS buyer_flow_bias FROM p2),
p4 AS (SELECT *, {", ".join(f"CASE WHEN round(stddev_samp({n}_bias_score) OVER wk, 9) > 0 AND count(*) OVER wk > 1 THEN ({n}_bias_score - avg({n}_bias_score) OVER wk) / stddev_samp({n}_bias_score) OVER wk END AS {n}_bias_z_week, ntile(100) OVER (PARTITION BY ticker, week_ending ORDER BY {n}_bias_score, strike, expiry_date) - 1 AS {n}_bias_percentile_week" for n in ("hold", "break"))}
       FROM p3 WINDOW wk AS (PARTITION BY ticker, week_ending))
SELECT {sql_rounded(TRENDS)} FROM p4"""


@register("positioning_trends", TRENDS_SQL)
def positioning_trends_query(spark, sf_dir):
    return select_rounded(positioning_trends(chain_of(spark, sf_dir)), TRENDS)
