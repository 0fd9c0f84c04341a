"""Option strategies priced by the model: legs as arrays, straddles held over the next sessions, profit split by its causes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import pricing
from tidemark.functions.numbers import safe_div
from tidemark.operators.series import forward, next_and_previous, numbered, series, streamed
from tidemark.plans.gold_chain import CHAIN, chain_of, select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.sources import adapters

# Days to expiry at entry, sessions held, cost of a crossing as a share of the price.
TENOR, HOLD, SPREAD = 45, 5, 0.03


def legs(strategy: str, spot: Column, width: float = 0.05) -> Column:
    """Array of (kind, strike, quantity) for a strategy at the given spot; strikes are whole numbers."""
    at = lambda x: F.round(spot * x, 0)
    leg = lambda kind, strike, q: F.struct(F.lit(kind).alias("kind"), strike.alias("strike"), F.lit(q).alias("quantity"))
    shapes = {
        "straddle": [("Call", 1.0, 1), ("Put", 1.0, 1)],
        "strangle": [("Call", 1 + width, 1), ("Put", 1 - width, 1)],
        "call": [("Call", 1.0, 1)],
        "put": [("Put", 1.0, 1)],
        "bull_call_spread": [("Call", 1.0, 1), ("Call", 1 + width, -1)],
        "bear_put_spread": [("Put", 1.0, 1), ("Put", 1 - width, -1)],
    }
    return F.array(*[leg(k, at(x), q) for k, x, q in shapes[strategy]])


def total(legs_: Column, value) -> Column:
    """Sum over the legs of quantity times value(kind, strike)."""
    return F.aggregate(F.transform(legs_, lambda x: x["quantity"] * value(x["kind"], x["strike"])), F.lit(0.0), lambda a, b: a + b)


# Fixed values of the smile, in volatility: a put's premium per unit of distance below the money and deep below it, a call's discount and
# where it ends, how much a fall of the spot steepens the puts; and of events: rise before earnings and ex-dividend days, days ahead.
PUT_SLOPE, PUT_DEEP, DEEP, CALL_SLOPE, CALL_END, STEEPER = 0.5, 0.04, 0.9, -0.1, 1.1, 0.5
EARNINGS_RISE, EARNINGS_DAYS, EXDIV_RISE, EXDIV_DAYS = 0.05, 14, 0.015, 7


def skewed(iv: Column, kind: Column, moneyness: Column, recent: Column | None = None) -> Column:
    """Volatility off the money (moneyness is strike over spot): puts dearer, by a flat premium deep below, calls a little cheaper;
    the puts' premium grows with a recent fall of the spot (its return, negative). In the money nothing is added."""
    put = F.when(moneyness < DEEP, F.lit(PUT_DEEP)).otherwise(PUT_SLOPE * F.greatest(1 - moneyness, F.lit(0.0)))
    steeper = 1 - STEEPER * F.least(F.coalesce(recent, F.lit(0.0)), F.lit(0.0)) if recent is not None else F.lit(1.0)
    return iv + F.when(kind == "Put", put * steeper).otherwise(CALL_SLOPE * (F.greatest(F.least(moneyness, F.lit(CALL_END)), F.lit(1.0)) - 1))


def event_rise(to_earnings: Column, to_exdiv: Column) -> Column:
    """What the days before earnings and ex-dividend days add to a day's volatility, the more the nearer; the day itself and
    those without an event in reach add nothing."""
    one = lambda days, rise, reach: F.when((days > 0) & (days <= reach), rise * (reach - days) / reach).otherwise(0.0)
    return one(to_earnings, EARNINGS_RISE, EARNINGS_DAYS) + one(to_exdiv, EXDIV_RISE, EXDIV_DAYS)


def at_tenor(iv: Column, base: float, target: Column, slope: float = 0.02) -> Column:
    return F.greatest(iv + slope * F.log(target / base), F.lit(0.05))


def daily_state(chain: DataFrame) -> DataFrame:
    """Spot and at-the-money volatility per ticker and day."""
    gap = F.round(F.abs(F.col("strike") - F.col("underlying_price")), 6)
    return chain.groupBy("ticker", "trade_date").agg(F.max("underlying_price").alias("spot"), F.min(F.struct(gap.alias("gap"), "strike", F.col("implied_volatility").alias("iv")))["iv"].alias("iv"))


def held_strategy(chain: DataFrame, strategy: str = "straddle", tenor: int = TENOR, hold: int = HOLD, rate: float = adapters.RATE) -> DataFrame:
    """Entered every day at the middle, left `hold` sessions later at the new spot and volatility, a spread paid both times."""
    w = series("ticker", "trade_date")
    s = daily_state(chain).withColumns({"exit_date": F.lead("trade_date", hold).over(w), "exit_spot": F.lead("spot", hold).over(w), "exit_iv": F.lead("iv", hold).over(w)}).where("exit_date is not null")
    s = s.withColumns({"days": F.datediff("exit_date", "trade_date"), "legs": legs(strategy, F.col("spot"))}).where(F.col("days") < tenor)
    r, t0, t1 = F.lit(rate), F.lit(tenor / 365.0), (tenor - F.col("days")) / 365
    now = lambda f: total(F.col("legs"), lambda k, x: f(k, F.col("spot"), x, t0, r, F.col("iv")))
    out = s.withColumns({
        "entry": now(pricing.price), "exit": total(F.col("legs"), lambda k, x: pricing.price(k, F.col("exit_spot"), x, t1, r, F.col("exit_iv"))), "vega": now(lambda k, *a: pricing.vega(*a)), "gamma": now(lambda k, *a: pricing.gamma(*a)), "theta": now(pricing.theta),
    })
    d_iv, d_spot = (F.col("exit_iv") - F.col("iv")) * 100, F.col("exit_spot") - F.col("spot")
    parts = pricing.pnl_parts(F.col("entry"), F.col("exit"), F.col("vega"), F.col("gamma"), F.col("theta"), d_iv, d_spot, F.col("days"))
    return out.withColumn("p", parts).withColumns({
        "pnl": F.col("p.total"), "vega_pnl": F.col("p.vega"), "gamma_pnl": F.col("p.gamma"), "theta_pnl": F.col("p.theta"), "rest_pnl": F.col("p.rest"), "net_pct": safe_div(F.col("exit") * (1 - SPREAD / 2) - F.col("entry") * (1 + SPREAD / 2), F.col("entry")) * 100,
    })


HELD = dict.fromkeys(["ticker", "trade_date", "exit_date", "days"]) | {c: 4 for c in "entry exit pnl vega_pnl gamma_pnl theta_pnl rest_pnl net_pct".split()}


_N1, _N2 = pricing.cdf_sql("d1"), pricing.cdf_sql("d2")


@register(
    "straddle_backtest",
    adapters.doubles(f"""
WITH {CHAIN},
n AS (SELECT ticker, trade_date, max(underlying_price) AS spot, arg_min(implied_volatility, row(round(abs(strike - underlying_price), 6), strike, implied_volatility)) AS iv FROM option_chain GROUP BY 1, 2),
x AS (SELECT *, lead(trade_date, {HOLD}) OVER w AS exit_date, lead(spot, {HOLD}) OVER w AS exit_spot, lead(iv, {HOLD}) OVER w AS exit_iv, round(spot, 0) AS k FROM n WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
h AS (SELECT *, CAST(exit_date - trade_date AS INTEGER) AS days FROM x WHERE exit_date IS NOT NULL AND exit_date - trade_date < {TENOR}),
q AS (SELECT ticker, trade_date, 0 AS leg, spot AS s, iv AS v, {TENOR} / 365.0 AS t, k FROM h UNION ALL SELECT ticker, trade_date, 1, exit_spot, exit_iv, ({TENOR} - days) / 365.0, k FROM h),
a AS MATERIALIZED (SELECT *, least(greatest((ln(s / k) + (0.03 + v * v / 2.0) * t) / (v * sqrt(t)), -10.0), 10.0) AS d1 FROM q),
b AS MATERIALIZED (SELECT *, d1 - v * sqrt(t) AS d2, k * exp(-0.03 * t) AS kd, exp(-d1 * d1 / 2.0) / sqrt(2.0 * pi()) AS pdf FROM a),
c AS MATERIALIZED (SELECT *, {_N1} AS n1, {_N2} AS n2 FROM b),
d AS MATERIALIZED (SELECT *, greatest(s * n1 - kd * n2, s - k, 0.0) AS call, greatest(kd * (1.0 - n2) - s * (1.0 - n1), k - s, 0.0) AS put, -s * pdf * v / (2.0 * sqrt(t)) AS decay FROM c),
g AS (SELECT *, call + put AS value, 2.0 * s * pdf * sqrt(t) / 100.0 AS vega, 2.0 * pdf / (s * v * sqrt(t)) AS gamma,
        CASE WHEN abs((decay - 0.03 * kd * n2) / 365.0) > call THEN 0.0 ELSE (decay - 0.03 * kd * n2) / 365.0 END + CASE WHEN abs((decay + 0.03 * kd * (1.0 - n2)) / 365.0) > put THEN 0.0 ELSE (decay + 0.03 * kd * (1.0 - n2)) / 365.0 END AS theta FROM d),
j AS (SELECT h.*, e.value AS entry, o.value AS exit, o.value - e.value AS pnl, e.vega * (exit_iv - iv) * 100 AS vega_pnl, 0.5 * e.gamma * (exit_spot - spot) * (exit_spot - spot) AS gamma_pnl, e.theta * days AS theta_pnl
      FROM h JOIN g e ON e.ticker = h.ticker AND e.trade_date = h.trade_date AND e.leg = 0 JOIN g o ON o.ticker = h.ticker AND o.trade_date = h.trade_date AND o.leg = 1),
r AS (SELECT *, pnl - vega_pnl - gamma_pnl - theta_pnl AS rest_pnl, (exit * {1 - SPREAD / 2} - entry * {1 + SPREAD / 2}) / nullif(entry, 0) * 100 AS net_pct FROM j)
SELECT {sql_rounded(HELD)} FROM r"""),
)
def straddle_backtest(spark, sf_dir):
    return select_rounded(held_strategy(chain_of(spark, sf_dir)), HELD)


def strategy_summary(held: DataFrame) -> DataFrame:
    """Per ticker: trades, win rate, mean, mean over spread of returns, and the shares of the profit's causes."""
    x = F.col("net_pct")
    whole = F.sum(F.abs("vega_pnl") + F.abs("gamma_pnl") + F.abs("theta_pnl"))
    return held.groupBy("ticker").agg(F.count("*").alias("n_trades"), F.avg((x > 0).cast("double")).alias("win_rate"), F.avg(x).alias("mean_pct"), safe_div(F.avg(x), F.stddev_samp(x)).alias("sharpe"), *[safe_div(F.sum(F.abs(f"{c}_pnl")), whole).alias(f"{c}_share") for c in ("vega", "gamma", "theta")])


STRANGLE = {"ticker": None, "n_trades": None} | {c: 4 for c in "win_rate mean_pct sharpe vega_share gamma_share theta_share".split()}


@register(
    "strangle_summary",
    adapters.doubles(f"""
WITH {CHAIN},
n AS (SELECT ticker, trade_date, max(underlying_price) AS spot, arg_min(implied_volatility, row(round(abs(strike - underlying_price), 6), strike, implied_volatility)) AS iv FROM option_chain GROUP BY 1, 2),
x AS (SELECT *, lead(trade_date, {HOLD}) OVER w AS exit_date, lead(spot, {HOLD}) OVER w AS exit_spot, lead(iv, {HOLD}) OVER w AS exit_iv FROM n WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
h AS (SELECT *, CAST(exit_date - trade_date AS INTEGER) AS days FROM x WHERE exit_date IS NOT NULL AND exit_date - trade_date < {TENOR}),
l AS (SELECT *, 'Call' AS kind, round(spot * 1.05, 0) AS k FROM h UNION ALL SELECT *, 'Put', round(spot * 0.95, 0) FROM h),
q AS (SELECT ticker, trade_date, kind, 0 AS leg, spot AS s, iv AS v, {TENOR} / 365.0 AS t, k FROM l UNION ALL SELECT ticker, trade_date, kind, 1, exit_spot, exit_iv, ({TENOR} - days) / 365.0, k FROM l),
a AS MATERIALIZED (SELECT *, least(greatest((ln(s / k) + (0.03 + v * v / 2.0) * t) / (v * sqrt(t)), -10.0), 10.0) AS d1 FROM q),
b AS MATERIALIZED (SELECT *, d1 - v * sqrt(t) AS d2, k * exp(-0.03 * t) AS kd, exp(-d1 * d1 / 2.0) / sqrt(2.0 * pi()) AS pdf FROM a),
c AS MATERIALIZED (SELECT *, {pricing.cdf_sql("d1")} AS n1, {pricing.cdf_sql("d2")} AS n2 FROM b),
d AS (SELECT *, CASE kind WHEN 'Call' THEN greatest(s * n1 - kd * n2, s - k, 0.0) ELSE greatest(kd * (1.0 - n2) - s * (1.0 - n1), k - s, 0.0) END AS value, -s * pdf * v / (2.0 * sqrt(t)) + CASE kind WHEN 'Call' THEN -0.03 * kd * n2 ELSE 0.03 * kd * (1.0 - n2) END AS yearly FROM c),
e AS (SELECT ticker, trade_date, leg, sum(value) AS value, sum(s * pdf * sqrt(t) / 100.0) AS vega, sum(pdf / (s * v * sqrt(t))) AS gamma, sum(CASE WHEN abs(yearly / 365.0) > value THEN 0.0 ELSE yearly / 365.0 END) AS theta FROM d GROUP BY ALL),
j AS (SELECT h.ticker, (o.value * {1 - SPREAD / 2} - e.value * {1 + SPREAD / 2}) / nullif(e.value, 0) * 100 AS net_pct, abs(e.vega * (exit_iv - iv) * 100) AS vp, abs(0.5 * e.gamma * (exit_spot - spot) * (exit_spot - spot)) AS gp, abs(e.theta * days) AS tp
      FROM h JOIN e ON e.ticker = h.ticker AND e.trade_date = h.trade_date AND e.leg = 0 JOIN e o ON o.ticker = h.ticker AND o.trade_date = h.trade_date AND o.leg = 1),
r AS (SELECT ticker, count(*) AS n_trades, avg(if(net_pct > 0, 1, 0)) AS win_rate, avg(net_pct) AS mean_pct, avg(net_pct) / nullif(stddev_samp(net_pct), 0) AS sharpe, sum(vp) / nullif(sum(vp + gp + tp), 0) AS vega_share, sum(gp) / nullif(sum(vp + gp + tp), 0) AS gamma_share, sum(tp) / nullif(sum(vp + gp + tp), 0) AS theta_share FROM j GROUP BY ticker)
SELECT {sql_rounded(STRANGLE)} FROM r"""),
)
def strangle_summary(spark, sf_dir):
    return select_rounded(strategy_summary(held_strategy(chain_of(spark, sf_dir), "strangle")), STRANGLE)


def volatility_paths(state: DataFrame, beta: float = 0.5, pull: float = 0.1, noise: float = 0.02, seed: int = 7, rise: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Simulated at-the-money volatility: pulled to its mean, moved by realised volatility, seeded noise and the column `rise`,
    five points at least. The recursion streams along each ticker's series. The columns `keep` are carried along."""
    w = Window.partitionBy("ticker").orderBy("trade_date")
    rows = state.withColumn("ret", F.log(F.col("spot") / F.lag("spot").over(w)))
    rows = rows.withColumn("rv", F.when(F.count("ret").over(w.rowsBetween(-19, 0)) >= 2, F.stddev_samp("ret").over(w.rowsBetween(-19, 0))) * F.sqrt(F.lit(252.0)))
    draw = (F.conv(F.substring(F.md5(F.concat_ws("|", "ticker", F.col("trade_date").cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("double") / 4294967296.0 - 0.5) * 3.4641  # unit spread, fixed by key and seed
    rows = rows.withColumns({"shock": F.coalesce(beta * (F.col("rv") - F.lag("rv").over(w)), F.lit(0.0)) + noise * draw + (F.col(rise) if rise else F.lit(0.0)), "mean": F.avg("iv").over(Window.partitionBy("ticker"))})
    rows = rows.select("ticker", "trade_date", "iv", "mean", "shock", *keep)

    def work(state: dict, part) -> list:
        out = []
        last = state.get("last")
        for mean, shock in zip(part.column(3).to_pylist(), part.column(4).to_pylist()):
            last = mean if last is None else last
            last = max(last + pull * (mean - last) + shock, 0.05)
            out.append(last)
        state["last"] = last
        return [pa.array(out, pa.float64())]

    return streamed(rows, "ticker", "trade_date", "simulated_iv double", work).select("ticker", "trade_date", "iv", "simulated_iv", *keep)


_STATE = "n AS (SELECT ticker, trade_date, max(underlying_price) AS spot, arg_min(implied_volatility, row(round(abs(strike - underlying_price), 6), strike, implied_volatility)) AS iv FROM option_chain GROUP BY 1, 2)"
PATHS = {"ticker": None, "trade_date": None, "iv": 6, "simulated_iv": 6}


@register(
    "volatility_paths",
    f"""
WITH RECURSIVE {CHAIN},{_STATE},
a AS (SELECT *, ln(spot / lag(spot) OVER w) AS ret, row_number() OVER w AS bar, avg(iv) OVER (PARTITION BY ticker) AS mean FROM n WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
b AS (SELECT *, CASE WHEN count(ret) OVER f >= 2 THEN stddev_samp(ret) OVER f END * sqrt(252) AS rv FROM a WINDOW f AS (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING)),
c AS MATERIALIZED (SELECT ticker, trade_date, iv, bar, mean, coalesce(0.5 * (rv - lag(rv) OVER (PARTITION BY ticker ORDER BY trade_date)), 0)
        + 0.02 * ((CAST('0x' || substr(md5(concat_ws('|', ticker, CAST(trade_date AS VARCHAR), '7')), 1, 8) AS BIGINT) / 4294967296.0 - 0.5) * 3.4641) AS shock FROM b),
p AS (SELECT ticker, bar, greatest(mean + shock, 0.05) AS simulated_iv FROM c WHERE bar = 1
      UNION ALL SELECT c.ticker, c.bar, greatest(p.simulated_iv + 0.1 * (mean - p.simulated_iv) + shock, 0.05) FROM p JOIN c ON c.ticker = p.ticker AND c.bar = p.bar + 1)
SELECT {sql_rounded(PATHS)} FROM c JOIN p USING (ticker, bar)""",
)
def volatility_paths_query(spark, sf_dir):
    return select_rounded(volatility_paths(daily_state(chain_of(spark, sf_dir))), PATHS)


BASE_TENOR, PREMIUM, UNKNOWN_VOL = 120, 0.02, 0.30
SMILES = {"ticker": None, "trade_date": None, "days_to_earnings": None, "days_to_exdiv": None} | {c: 6 for c in "rise simulated_iv iv_30d iv_240d put_85 put_95 call_105 call_115".split()}


def calibrated_state(bars: DataFrame) -> DataFrame:
    """Spot per ticker and day, and as its volatility the realised one of 20 returns (30 points where there are not two) with the
    premium that options carry over it: its mean is what a path is pulled to."""
    w = series("ticker", "trade_date")
    rows = bars.select("ticker", "trade_date", F.col("close").alias("spot")).withColumn("ret", F.log(F.col("spot") / F.lag("spot").over(w)))
    near = w.rowsBetween(-19, 0)
    rv = F.when(F.count("ret").over(near) >= 2, F.stddev_samp("ret").over(near)) * F.sqrt(F.lit(252.0))
    return rows.select("ticker", "trade_date", "spot", (F.coalesce(rv, F.lit(UNKNOWN_VOL)) + PREMIUM).alias("iv"))


def volatility_smiles(state: DataFrame, earnings: DataFrame, dividends: DataFrame, term_slope: float = 0.02) -> DataFrame:
    """Simulated volatility with the rises before earnings and ex-dividend days, taken for BASE_TENOR days, shifted to shorter and
    longer tenors by a line in log time, and off the money by kind, steeper for puts after a fall."""
    s = next_and_previous(state, earnings, "ticker", "trade_date", "earnings_date", "earnings")
    s = next_and_previous(s, dividends, "ticker", "trade_date", "ex_dividend_date", "exdiv")
    s = s.withColumns({"days_to_earnings": F.datediff("earnings_next", "trade_date").cast("long"), "days_to_exdiv": F.datediff("exdiv_next", "trade_date").cast("long")})
    s = s.withColumns({"rise": event_rise(F.col("days_to_earnings"), F.col("days_to_exdiv")), "recent": F.col("spot") / F.lag("spot").over(series("ticker", "trade_date")) - 1})
    paths = volatility_paths(s, rise="rise", keep=("rise", "recent", "days_to_earnings", "days_to_exdiv"))
    iv = F.col("simulated_iv")
    off = lambda kind, m: skewed(iv, F.lit(kind), F.lit(m), F.col("recent"))
    return paths.withColumns({"iv_30d": at_tenor(iv, BASE_TENOR, F.lit(30), term_slope), "iv_240d": at_tenor(iv, BASE_TENOR, F.lit(240), term_slope), "put_85": off("Put", 0.85), "put_95": off("Put", 0.95), "call_105": off("Call", 1.05), "call_115": off("Call", 1.15)})


@register(
    "volatility_smiles",
    f"""
WITH RECURSIVE {adapters.oracle("bars_daily", "calendar_earnings")},
n AS (SELECT ticker, trade_date, close AS spot FROM bars_daily),
g AS MATERIALIZED (SELECT n.*, (SELECT min(earnings_date) FROM calendar_earnings e WHERE e.ticker = n.ticker AND e.earnings_date >= n.trade_date) - trade_date AS days_to_earnings,
        (SELECT min(ex_dividend_date) FROM calendar_dividends e WHERE e.ticker = n.ticker AND e.ex_dividend_date >= n.trade_date) - trade_date AS days_to_exdiv FROM n),
h AS (SELECT *, CASE WHEN days_to_earnings BETWEEN 1 AND {EARNINGS_DAYS} THEN {EARNINGS_RISE} * ({EARNINGS_DAYS} - days_to_earnings) / {EARNINGS_DAYS} ELSE 0 END + CASE WHEN days_to_exdiv BETWEEN 1 AND {EXDIV_DAYS} THEN {EXDIV_RISE} * ({EXDIV_DAYS} - days_to_exdiv) / {EXDIV_DAYS} ELSE 0 END AS rise FROM g),
a AS (SELECT *, ln(spot / lag(spot) OVER w) AS ret, spot / lag(spot) OVER w - 1 AS recent, row_number() OVER w AS bar FROM h WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
b AS (SELECT *, CASE WHEN count(ret) OVER f >= 2 THEN stddev_samp(ret) OVER f END * sqrt(252) AS rv FROM a WINDOW f AS (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING)),
c AS MATERIALIZED (SELECT ticker, trade_date, days_to_earnings, days_to_exdiv, rise, recent, bar, avg(coalesce(rv, {UNKNOWN_VOL}) + {PREMIUM}) OVER (PARTITION BY ticker) AS mean, coalesce(0.5 * (rv - lag(rv) OVER (PARTITION BY ticker ORDER BY trade_date)), 0)
        + 0.02 * ((CAST('0x' || substr(md5(concat_ws('|', ticker, CAST(trade_date AS VARCHAR), '7')), 1, 8) AS BIGINT) / 4294967296.0 - 0.5) * 3.4641) + rise AS shock FROM b),
p AS (SELECT ticker, bar, greatest(mean + shock, 0.05) AS iv FROM c WHERE bar = 1
      UNION ALL SELECT c.ticker, c.bar, greatest(p.iv + 0.1 * (mean - p.iv) + shock, 0.05) FROM p JOIN c ON c.ticker = p.ticker AND c.bar = p.bar + 1),
z AS (SELECT c.*, iv AS simulated_iv, greatest(iv + 0.02 * ln(30 / {BASE_TENOR}), 0.05) AS iv_30d, greatest(iv + 0.02 * ln(240 / {BASE_TENOR}), 0.05) AS iv_240d, 1 - {STEEPER} * least(coalesce(recent, 0), 0) AS steeper FROM c JOIN p USING (ticker, bar)),
o AS (SELECT *, simulated_iv + {PUT_DEEP} * steeper AS put_85, simulated_iv + {PUT_SLOPE} * (1 - 0.95) * steeper AS put_95, simulated_iv + {CALL_SLOPE} * (1.05 - 1) AS call_105, simulated_iv + {CALL_SLOPE} * ({CALL_END} - 1) AS call_115 FROM z)
SELECT {sql_rounded(SMILES)} FROM o""",
)
def volatility_smiles_query(spark, sf_dir):
    bars, earnings, dividends = (adapters.load(spark, sf_dir, n) for n in ("bars_daily", "calendar_earnings", "calendar_dividends"))
    return select_rounded(volatility_smiles(calibrated_state(bars), earnings, dividends), SMILES)


# Exits before the time is up

LONGEST, STOP, TAKE = 10, 0.20, 0.20  # sessions held at most, loss and gain at which a position is closed


def backtest(chain: DataFrame, strategy: str = "straddle", tenor: int = TENOR, hold: int = LONGEST, stop: float | None = STOP, take: float | None = TAKE, rate: float = adapters.RATE) -> DataFrame:
    """Entered every day, repriced at each of the next `hold` sessions, closed at the first whose return reaches -stop or take,
    else at the last one. Strikes are those around the forward price; a spread is paid twice; the profit is split by cause."""
    state = numbered(daily_state(chain), "ticker", "trade_date")
    w = series("ticker", "trade_date")
    rv = F.stddev_samp("ret").over(w.rowsBetween(-19, 0)) * F.sqrt(F.lit(252.0))
    state = state.withColumn("ret", F.log(F.col("spot") / F.lag("spot").over(w))).withColumn("rv", F.when(F.count("ret").over(w.rowsBetween(-19, 0)) >= 20, rv))
    r, t0 = F.lit(rate), F.lit(tenor / 365.0)
    entered = state.withColumn("legs", legs(strategy, F.col("spot") * F.exp(r * t0)))
    at = lambda f: total(F.col("legs"), lambda kind, k: f(kind, F.col("spot"), k, t0, r, F.col("iv")))
    entered = entered.withColumns({"entry": at(pricing.price), "vega": at(lambda kind, *a: pricing.vega(*a)), "gamma": at(lambda kind, *a: pricing.gamma(*a)), "theta": at(pricing.theta)}).where("entry > 0")
    ahead = forward(entered, state, "ticker", "idx", hold, ["trade_date", "spot", "iv", "rv"])
    days = F.datediff("f_trade_date", "trade_date")
    ahead = ahead.withColumn("days", days).withColumn("t1", F.greatest(tenor - F.col("days"), F.lit(0)) / 365)
    ahead = ahead.withColumn("value", total(F.col("legs"), lambda kind, k: pricing.price(kind, F.col("f_spot"), k, F.col("t1"), r, F.col("f_iv"))))
    ret = F.col("value") / F.col("entry") - 1
    rule = F.when(ret <= -stop, "stop_loss") if stop else F.when(F.lit(False), "")
    rule = rule.when(ret >= take, "take_profit") if take else rule
    ahead = ahead.withColumn("rule", rule)
    first = F.when(F.col("rule").isNotNull(), F.col("step")).otherwise(10_000 - F.col("step"))
    keys = ["ticker", "trade_date", "spot", "iv", "rv", "entry", "vega", "gamma", "theta"]
    out = ahead.groupBy(*keys).agg(F.min_by(F.struct(F.col("f_trade_date").alias("exit_date"), F.col("f_spot").alias("exit_spot"), F.col("f_iv").alias("exit_iv"), F.col("f_rv").alias("exit_rv"), F.col("value").alias("exit"), "days", F.coalesce("rule", F.lit("time")).alias("exit_rule")), first).alias("x"))
    out = out.select(*keys, "x.*")
    d_iv, d_spot = (F.col("exit_iv") - F.col("iv")) * 100, F.col("exit_spot") - F.col("spot")
    out = out.withColumn("p", pricing.pnl_parts(F.col("entry"), F.col("exit"), F.col("vega"), F.col("gamma"), F.col("theta"), d_iv, d_spot, F.col("days")))
    return out.withColumns({"gross_pct": F.col("p.total") / F.col("entry") * 100, "net_pct": (F.col("p.total") / F.col("entry") - 2 * SPREAD) * 100, "vega_pnl": F.col("p.vega"), "gamma_pnl": F.col("p.gamma"), "theta_pnl": F.col("p.theta"), "days": F.col("days").cast("long")})


BACKTEST = dict.fromkeys(["ticker", "trade_date", "exit_date", "exit_rule", "days"]) | {c: 4 for c in "entry exit gross_pct net_pct vega_pnl gamma_pnl theta_pnl".split()}
BACKTEST_CTE = f"""{_STATE},
ba AS (SELECT *, row_number() OVER w AS idx, ln(spot / lag(spot) OVER w) AS ret FROM n WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
bb AS (SELECT *, CASE WHEN count(ret) OVER f >= 20 THEN stddev_samp(ret) OVER f END * sqrt(252.0) AS rv, round(spot * exp({adapters.RATE} * {TENOR} / 365.0), 0) AS k FROM ba WINDOW f AS (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING)),
bc AS (SELECT ticker, idx, 0 AS step, trade_date AS entered, trade_date AS d, 0 AS days, k, spot AS s, iv AS v, rv, {TENOR} / 365.0 AS t FROM bb
       UNION ALL SELECT e.ticker, e.idx, x.idx - e.idx, e.trade_date, x.trade_date, x.trade_date - e.trade_date, e.k, x.spot, x.iv, x.rv, greatest({TENOR} - (x.trade_date - e.trade_date), 0) / 365.0 FROM bb e JOIN bb x ON x.ticker = e.ticker AND x.idx > e.idx AND x.idx <= e.idx + {LONGEST}),
bd AS MATERIALIZED (SELECT *, CASE WHEN t > 0 THEN least(greatest((ln(s / k) + ({adapters.RATE} + v * v / 2.0) * t) / (v * sqrt(t)), -10.0), 10.0) WHEN s > k THEN 1000.0 ELSE -1000.0 END AS d1 FROM bc),
be AS MATERIALIZED (SELECT *, d1 - v * sqrt(t) AS d2, k * exp(-{adapters.RATE} * t) AS kd, exp(-d1 * d1 / 2.0) / sqrt(2.0 * pi()) AS pdf FROM bd),
bf AS MATERIALIZED (SELECT *, {_N1} AS n1, {_N2} AS n2 FROM be),
bg AS (SELECT *, CASE WHEN t > 0 THEN greatest(s * n1 - kd * n2, s - k, 0.0) ELSE greatest(s - k, 0.0) END AS call, CASE WHEN t > 0 THEN greatest(kd * (1.0 - n2) - s * (1.0 - n1), k - s, 0.0) ELSE greatest(k - s, 0.0) END AS put, CASE WHEN t > 0 THEN -s * pdf * v / (2.0 * sqrt(t)) END AS decay FROM bf),
bh AS (SELECT *, call + put AS value, 2.0 * s * pdf * sqrt(t) / 100.0 AS vega, CASE WHEN t > 0 THEN 2.0 * pdf / (s * v * sqrt(t)) END AS gamma,
        CASE WHEN abs((decay - {adapters.RATE} * kd * n2) / 365.0) > call THEN 0.0 ELSE (decay - {adapters.RATE} * kd * n2) / 365.0 END + CASE WHEN abs((decay + {adapters.RATE} * kd * (1.0 - n2)) / 365.0) > put THEN 0.0 ELSE (decay + {adapters.RATE} * kd * (1.0 - n2)) / 365.0 END AS theta FROM bg),
bi AS (SELECT h.*, e.value AS entry, CASE WHEN h.value / e.value - 1 <= -{STOP} THEN 'stop_loss' WHEN h.value / e.value - 1 >= {TAKE} THEN 'take_profit' END AS rule FROM bh h JOIN bh e ON e.ticker = h.ticker AND e.idx = h.idx AND e.step = 0 WHERE h.step > 0 AND e.value > 0),
bj AS (SELECT * FROM bi QUALIFY row_number() OVER (PARTITION BY ticker, idx ORDER BY CASE WHEN rule IS NOT NULL THEN step ELSE 10000 - step END) = 1),
backtests AS (SELECT j.ticker, e.entered AS trade_date, j.d AS exit_date, coalesce(rule, 'time') AS exit_rule, j.days AS days, entry, j.value AS exit, (j.value / entry - 1) * 100 AS gross_pct, (j.value / entry - 1 - {2 * SPREAD}) * 100 AS net_pct,
        e.vega * (j.v - e.v) * 100 AS vega_pnl, 0.5 * e.gamma * (j.s - e.s) * (j.s - e.s) AS gamma_pnl, e.theta * j.days AS theta_pnl, e.v AS iv, e.rv AS rv, j.v AS exit_iv, j.rv AS exit_rv FROM bj j JOIN bh e ON e.ticker = j.ticker AND e.idx = j.idx AND e.step = 0)"""


@register("option_backtest", adapters.doubles(f"WITH {CHAIN},{BACKTEST_CTE} SELECT {sql_rounded(BACKTEST)} FROM backtests"))
def option_backtest(spark, sf_dir):
    return select_rounded(backtest(chain_of(spark, sf_dir)), BACKTEST)


SUMMARY = {"ticker": None, "n_trades": None} | {c: 4 for c in "win_rate mean_pct median_pct sharpe best_pct worst_pct vega_share gamma_share theta_share mean_premium mean_iv_change mean_rv_change".split()} | {"stops": None, "takes": None, "time_exits": None}


def backtest_summary(trades: DataFrame) -> DataFrame:
    """Per ticker: returns, mean over spread, the causes' shares of what they explain, premium of implied over realised
    volatility at entry, changes until the exit, and exits by rule."""
    x, parts = F.col("net_pct"), ["vega", "gamma", "theta"]
    whole = F.sum(F.col("vega_pnl") + F.col("gamma_pnl") + F.col("theta_pnl"))
    return trades.groupBy("ticker").agg(
        F.count("*").alias("n_trades"), (F.avg((x > 0).cast("double")) * 100).alias("win_rate"), F.avg(x).alias("mean_pct"), F.median(x).alias("median_pct"), safe_div(F.avg(x), F.stddev_samp(x)).alias("sharpe"), F.max(x).alias("best_pct"), F.min(x).alias("worst_pct"),
        *[safe_div(F.sum(f"{c}_pnl"), whole).alias(f"{c}_share") for c in parts], F.avg(F.col("iv") - F.col("rv")).alias("mean_premium"), F.avg(F.col("exit_iv") - F.col("iv")).alias("mean_iv_change"), F.avg(F.col("exit_rv") - F.col("rv")).alias("mean_rv_change"),
        *[F.count(F.when(F.col("exit_rule") == rule, 1)).alias(name) for rule, name in (("stop_loss", "stops"), ("take_profit", "takes"), ("time", "time_exits"))],
    )


@register(
    "option_backtest_summary",
    adapters.doubles(f"""
WITH {CHAIN},{BACKTEST_CTE},
s AS (SELECT ticker, count(*) AS n_trades, avg(if(net_pct > 0, 1, 0)) * 100 AS win_rate, avg(net_pct) AS mean_pct, median(net_pct) AS median_pct, avg(net_pct) / nullif(stddev_samp(net_pct), 0) AS sharpe, max(net_pct) AS best_pct, min(net_pct) AS worst_pct,
        {", ".join(f"sum({c}_pnl) / nullif(sum(vega_pnl + gamma_pnl + theta_pnl), 0) AS {c}_share" for c in ("vega", "gamma", "theta"))}, avg(iv - rv) AS mean_premium, avg(exit_iv - iv) AS mean_iv_change, avg(exit_rv - rv) AS mean_rv_change,
        count(*) FILTER (exit_rule = 'stop_loss') AS stops, count(*) FILTER (exit_rule = 'take_profit') AS takes, count(*) FILTER (exit_rule = 'time') AS time_exits FROM backtests GROUP BY ticker)
SELECT {sql_rounded(SUMMARY)} FROM s"""),
)
def option_backtest_summary(spark, sf_dir):
    return select_rounded(backtest_summary(backtest(chain_of(spark, sf_dir))), SUMMARY)
