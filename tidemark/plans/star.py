"""Star schema and merged chain out of two quote sources with re-scraped rows, event-calendar features, and pricing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import pricing
from tidemark.functions.dates import next_opex, quarter_end, third_friday
from tidemark.functions.numbers import safe_div
from tidemark.operators.rows import latest_by, nth_by
from tidemark.operators.series import next_and_previous
from tidemark.plans.gold_chain import CHAIN, chain_of, select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.session import stored
from tidemark.sources import adapters

CONTRACT = ["ticker", "option_type", "strike", "expiry_date"]


def two_sources(chain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chain as two sources see it: the first has quotes for some contracts, the second scrapes each contract twice and
    knows open interest."""
    first = chain.where(F.col("bid").isNotNull()).select(*CONTRACT, "trade_date", "bid", "ask", "last_price", "volume", "underlying_price")
    scrapes = chain.withColumn("scrape", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).where((F.col("scrape") < 3) | (F.col("open_interest") % 20 == 0))
    second = scrapes.select(*CONTRACT, "trade_date", "scrape", (F.col("open_interest") + F.col("scrape") * 10).alias("open_interest"), F.col("last_price").alias("close_price"), "underlying_price", "implied_volatility")
    return first, second


SOURCES_CTE = """
src1 AS (SELECT ticker, option_type, strike, expiry_date, trade_date, bid, ask, last_price, volume, underlying_price FROM option_chain WHERE bid IS NOT NULL),
src2 AS (SELECT ticker, option_type, strike, expiry_date, trade_date, s.scrape, open_interest + s.scrape * 10 AS open_interest, last_price AS close_price, underlying_price, implied_volatility
         FROM option_chain, (VALUES (1), (2), (3)) s(scrape) WHERE s.scrape < 3 OR open_interest % 20 = 0)"""


def contract_id(*cols: str):
    """MD5 of the contract's parts, the strike always with two decimals."""
    return F.md5(F.concat_ws("|", *[F.format_string("%.2f", c) if c == "strike" else F.col(c).cast("string") for c in cols]))


def dim_contract(first: DataFrame, second: DataFrame) -> DataFrame:
    every = first.select(*CONTRACT).union(second.select(*CONTRACT)).distinct()
    return every.select(contract_id(*CONTRACT).alias("option_id"), F.md5("ticker").alias("underlying_id"), *CONTRACT)


_ID = "md5(concat_ws('|', ticker, option_type, format('{:.2f}', strike), CAST(expiry_date AS VARCHAR)))"


@register("dim_option_contract", f"WITH {CHAIN},{SOURCES_CTE} SELECT {_ID} AS option_id, md5(ticker) AS underlying_id, * FROM (SELECT ticker, option_type, strike, expiry_date FROM src1 UNION SELECT ticker, option_type, strike, expiry_date FROM src2)")
def dim_option_contract(spark, sf_dir):
    return dim_contract(*two_sources(chain_of(spark, sf_dir)))


def fact_eod(second: DataFrame) -> DataFrame:
    """The newest scrape of each contract-day."""
    return latest_by(second, [*CONTRACT, "trade_date"], [F.desc("scrape")]).withColumn("option_id", contract_id(*CONTRACT))


@register("fact_option_eod", f"WITH {CHAIN},{SOURCES_CTE} SELECT {_ID} AS option_id, trade_date, CAST(scrape AS BIGINT) AS scrape, open_interest, close_price, implied_volatility FROM src2 QUALIFY row_number() OVER (PARTITION BY ticker, option_type, strike, expiry_date, trade_date ORDER BY scrape DESC) = 1")
def fact_option_eod(spark, sf_dir):
    return fact_eod(two_sources(chain_of(spark, sf_dir))[1]).select("option_id", "trade_date", F.col("scrape").cast("long"), "open_interest", "close_price", "implied_volatility")


@register("second_newest_scrape", f"WITH {CHAIN},{SOURCES_CTE} SELECT ticker, trade_date, option_type, strike, expiry_date, CAST(scrape AS BIGINT) AS scrape FROM src2 QUALIFY row_number() OVER (PARTITION BY ticker, option_type, strike, expiry_date, trade_date ORDER BY scrape DESC) = 2")
def second_newest_scrape(spark, sf_dir):
    return nth_by(two_sources(chain_of(spark, sf_dir))[1], [*CONTRACT, "trade_date"], [F.desc("scrape")], 2).select("ticker", "trade_date", "option_type", "strike", "expiry_date", F.col("scrape").cast("long"))


def merged_chain(first: DataFrame, second: DataFrame) -> DataFrame:
    """Second source enriched by the first one's quotes, with middle price, spread, intrinsic and time value."""
    eod = fact_eod(second)
    both = eod.alias("b").join(first.drop("underlying_price"), [*CONTRACT, "trade_date"], "left")
    bid, ask, s, k = F.col("bid"), F.col("ask"), F.col("underlying_price"), F.col("strike")
    quoted = (bid > 0) & (ask > 0)
    mid = F.when(quoted, (bid + ask) / 2)
    inner = F.greatest(F.when(F.col("option_type") == "Call", s - k).otherwise(k - s), F.lit(0.0))
    last = F.coalesce("last_price", "close_price")
    return both.withColumns({
        "last": last, "mid_price": mid, "spread_abs": F.when(quoted, ask - bid), "spread_pct": F.when(quoted, safe_div(ask - bid, mid) * 100), "intrinsic_value": inner, "time_value": F.greatest(last - inner, F.lit(0.0)),
        "moneyness": safe_div(s, k), "has_quotes": bid.isNotNull(),
    })


MERGED = dict.fromkeys(["ticker", "option_type", "strike", "expiry_date", "trade_date", "open_interest", "has_quotes"]) | {"last": 4, "mid_price": 6, "spread_abs": 6, "spread_pct": 4, "intrinsic_value": 4, "time_value": 4, "moneyness": 6}


@register(
    "silver_chain_merged",
    f"""
WITH {CHAIN},{SOURCES_CTE},
e AS MATERIALIZED (SELECT * FROM src2 QUALIFY row_number() OVER (PARTITION BY ticker, option_type, strike, expiry_date, trade_date ORDER BY scrape DESC) = 1),
j AS MATERIALIZED (SELECT e.*, bid, ask, coalesce(last_price, close_price) AS last, greatest(CASE option_type WHEN 'Call' THEN e.underlying_price - strike ELSE strike - e.underlying_price END, 0) AS intrinsic_value FROM e LEFT JOIN src1 USING (ticker, option_type, strike, expiry_date, trade_date)),
m AS (SELECT *, CASE WHEN bid > 0 AND ask > 0 THEN (bid + ask) / 2 END AS mid_price, CASE WHEN bid > 0 AND ask > 0 THEN ask - bid END AS spread_abs, greatest(last - intrinsic_value, 0) AS time_value, underlying_price / strike AS moneyness, bid IS NOT NULL AS has_quotes FROM j),
p AS (SELECT *, spread_abs / nullif(mid_price, 0) * 100 AS spread_pct FROM m)
SELECT {sql_rounded(MERGED)} FROM p""",
)
def silver_chain_merged(spark, sf_dir):
    return select_rounded(merged_chain(*two_sources(chain_of(spark, sf_dir))), MERGED)


# Calendar features


def event_features(bars: DataFrame, earnings: DataFrame, dividends: DataFrame, cap: int = 90) -> DataFrame:
    """Days to and since earnings and ex-dividend days (capped), option expiry and calendar distances, flags."""
    f = next_and_previous(bars.select("ticker", "trade_date", "close"), earnings, "ticker", "trade_date", "earnings_date", "earnings")
    f = next_and_previous(f, dividends, "ticker", "trade_date", "ex_dividend_date", "exdiv", "amount")
    d = F.col("trade_date")
    days = lambda a, b: F.least(F.datediff(a, b), F.lit(cap)).cast("long")
    f = f.withColumns({
        "days_to_earnings": days(F.col("earnings_next"), d), "days_since_earnings": days(d, F.col("earnings_prev")), "days_to_exdiv": days(F.col("exdiv_next"), d), "days_since_exdiv": days(d, F.col("exdiv_prev")),
        "days_to_opex": F.datediff(next_opex(d), d).cast("long"), "is_opex_day": d == third_friday(d), "days_to_month_end": F.datediff(F.last_day(d), d).cast("long"), "days_to_quarter_end": F.datediff(quarter_end(d), d).cast("long"),
    })
    e, x = F.col("days_to_earnings"), F.col("days_to_exdiv")
    return f.withColumns({
        "is_earnings_week": (e <= 7).cast("int"), "is_pre_exdiv": (x <= 3).cast("int"), "dividend_yield": safe_div(F.col("exdiv_value") * 2, F.col("close")),
        "earnings_bucket": F.when(e <= 1, "imminent").when(e <= 7, "week").when(e <= 30, "month").when(e.isNotNull(), "far").otherwise("none"),
    })


EVENT_FEATURES = dict.fromkeys("ticker trade_date earnings_next earnings_prev exdiv_next exdiv_prev days_to_earnings days_since_earnings days_to_exdiv days_since_exdiv days_to_opex is_opex_day days_to_month_end days_to_quarter_end is_earnings_week is_pre_exdiv earnings_bucket".split()) | {"dividend_yield": 9}
_FRIDAY3 = "(date_trunc('month', {0})::DATE + CAST((19 - dayofweek(date_trunc('month', {0}))) % 7 + 14 AS INTEGER))"


@register(
    "event_features",
    f"""
WITH {adapters.oracle("bars_daily", "calendar_earnings")},
a AS (SELECT b.ticker, b.trade_date, b.close, (SELECT min(earnings_date) FROM calendar_earnings e WHERE e.ticker = b.ticker AND e.earnings_date >= b.trade_date) AS earnings_next, (SELECT max(earnings_date) FROM calendar_earnings e WHERE e.ticker = b.ticker AND e.earnings_date < b.trade_date) AS earnings_prev,
        (SELECT min(ex_dividend_date) FROM calendar_dividends e WHERE e.ticker = b.ticker AND e.ex_dividend_date >= b.trade_date) AS exdiv_next, (SELECT max(ex_dividend_date) FROM calendar_dividends e WHERE e.ticker = b.ticker AND e.ex_dividend_date < b.trade_date) AS exdiv_prev FROM bars_daily b),
c AS (SELECT a.*, amount, {_FRIDAY3.format("trade_date")} AS own, {_FRIDAY3.format("(trade_date + INTERVAL 1 MONTH)")} AS following FROM a LEFT JOIN calendar_dividends v ON v.ticker = a.ticker AND v.ex_dividend_date = a.exdiv_next),
d AS (SELECT *, least(earnings_next - trade_date, 90) AS days_to_earnings, least(trade_date - earnings_prev, 90) AS days_since_earnings, least(exdiv_next - trade_date, 90) AS days_to_exdiv, least(trade_date - exdiv_prev, 90) AS days_since_exdiv,
        CASE WHEN own >= trade_date THEN own ELSE following END - trade_date AS days_to_opex, own = trade_date AS is_opex_day, last_day(trade_date) - trade_date AS days_to_month_end, last_day((date_trunc('quarter', trade_date) + INTERVAL 2 MONTH)::DATE) - trade_date AS days_to_quarter_end FROM c),
f AS (SELECT *, CAST(days_to_earnings <= 7 AS INTEGER) AS is_earnings_week, CAST(days_to_exdiv <= 3 AS INTEGER) AS is_pre_exdiv, amount * 2 / close AS dividend_yield,
        CASE WHEN days_to_earnings <= 1 THEN 'imminent' WHEN days_to_earnings <= 7 THEN 'week' WHEN days_to_earnings <= 30 THEN 'month' WHEN days_to_earnings IS NOT NULL THEN 'far' ELSE 'none' END AS earnings_bucket FROM d)
SELECT {sql_rounded(EVENT_FEATURES)} FROM f""",
)
def event_features_query(spark, sf_dir):
    return select_rounded(event_features(*(adapters.load(spark, sf_dir, n) for n in ("bars_daily", "calendar_earnings", "calendar_dividends"))), EVENT_FEATURES)


# Pricing over the whole chain


GREEKS = ("delta", "gamma", "theta", "vega", "rho", "vanna", "charm")


def solved(chain: DataFrame, paid: Column, t: Column, rate: Column) -> DataFrame:
    """chain with iv, the volatility solved from the price paid. Rows are small but dear, so they are dealt out evenly, and what is
    solved is stored: later columns must not solve it again."""
    parts = int(chain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(chain.repartition(parts).withColumn("iv", pricing.implied_vol(F.col("option_type"), paid, F.col("underlying_price"), F.col("strike"), t, rate)))


def priced(chain: DataFrame, rate: float = adapters.RATE) -> DataFrame:
    """Implied volatility from the traded price, the price at it, and all Greeks; nulls where no volatility gives the price or the
    volatility fails the gates."""
    s, k, t, r, kind = F.col("underlying_price"), F.col("strike"), F.col("days_to_expiry") / 365, F.lit(rate), F.col("option_type")
    inner = F.greatest(F.when(kind == "Call", s - k).otherwise(k - s), F.lit(0.0))
    some = chain.where((F.col("days_to_expiry") > 0) & s.between(0.3 * k, 5 * k) & (F.col("last_price") > 0.01))
    iv = solved(some, F.col("last_price"), t, r).withColumn("inner", inner)
    v = F.col("iv")
    d = F.col("d1")
    out = iv.withColumn("d1", pricing.d1(s, k, t, r, v)).withColumns({"repriced": pricing.price(kind, s, k, t, r, v, d), "g": pricing.greeks(kind, s, k, t, r, v, d)})
    good = v.between(0.05, 2.0) & (F.abs(F.col("repriced") - F.col("last_price")) <= 0.01 * F.col("last_price")) & (F.col("last_price") - F.col("inner") >= -0.05)
    return out.withColumns({"iv_ok": F.coalesce(good, F.lit(False)), **{n: F.when(good, F.col(f"g.{n}")) for n in GREEKS}})


FROM_PRICES = dict.fromkeys(["ticker", "option_type", "strike", "expiry_date", "trade_date", "iv_ok"]) | {"iv": 4, "repriced": 4} | dict.fromkeys(GREEKS, 4)
HALVINGS = 48


def d1_sql(v: str) -> str:
    return f"least(greatest((ln(underlying_price / strike) + (rate + {v} * {v} / 2.0) * t) / ({v} * sqrt(t)), -10.0), 10.0)"


def price_from(n1: str, n2: str) -> str:
    disc = "strike * exp(-rate * t)"
    return f"CASE option_type WHEN 'Call' THEN greatest(underlying_price * {n1} - {disc} * {n2}, underlying_price - strike, 0.0) ELSE greatest({disc} * (1.0 - {n2}) - underlying_price * (1.0 - {n1}), strike - underlying_price, 0.0) END"


def valued_sql(v: str, source: str, name: str) -> str:
    """Common table expressions that add <name>, the model's price at v, to the rows of source; the last is called <source>_<name>."""
    x = f"{source}_{name}"
    return f"""
{x}_d AS MATERIALIZED (SELECT *, {d1_sql(v)} AS x1 FROM {source}),
{x}_n AS MATERIALIZED (SELECT *, {pricing.cdf_sql("x1")} AS n1, {pricing.cdf_sql(f"(x1 - {v} * sqrt(t))")} AS n2 FROM {x}_d),
{x} AS MATERIALIZED (SELECT * EXCLUDE (x1, n1, n2), {price_from("n1", "n2")} AS {name} FROM {x}_n)"""


def solved_sql(source: str) -> str:
    """Common table expressions that add iv by halving to the rows (id, option_type, underlying_price, strike, rate, t, paid) of
    source; the last is called <source>_iv. To stand in a WITH RECURSIVE."""
    low, high = "0.0001", "5.0"
    return f"""
{valued_sql(low, source, "least")},
{valued_sql(high, f"{source}_least", "most")},
{source}_open AS MATERIALIZED (SELECT id, option_type, underlying_price, strike, rate, t, paid FROM {source}_least_most WHERE t > 0 AND paid > 0 AND least < paid AND most >= paid),
{source}_halved AS (
  SELECT id, 0 AS n, {low} AS lo, {high} AS hi FROM {source}_open
  UNION ALL
  SELECT id, n + 1, CASE WHEN at_mid < paid THEN mid ELSE lo END, CASE WHEN at_mid < paid THEN hi ELSE mid END FROM (
    SELECT id, n, lo, hi, mid, paid, {price_from("n1", "n2")} AS at_mid FROM (
      SELECT *, {pricing.cdf_sql("x1")} AS n1, {pricing.cdf_sql("(x1 - mid * sqrt(t))")} AS n2 FROM (
        SELECT *, {d1_sql("mid")} AS x1 FROM (SELECT q.*, n, lo, hi, (lo + hi) / 2.0 AS mid FROM {source}_halved JOIN {source}_open q USING (id) WHERE n < {HALVINGS}))))),
{source}_found AS MATERIALIZED (SELECT id, (lo + hi) / 2.0 AS iv FROM {source}_halved WHERE n = {HALVINGS}),
{source}_iv AS MATERIALIZED (SELECT s.*, iv FROM {source} s LEFT JOIN {source}_found USING (id))"""


@register(
    "greeks_from_prices",
    adapters.doubles(f"""
WITH RECURSIVE {CHAIN},
q AS MATERIALIZED (SELECT row_number() OVER () AS id, ticker, option_type, strike, expiry_date, trade_date, underlying_price, last_price AS paid, days_to_expiry / 365.0 AS t, {adapters.RATE} AS rate, greatest(CASE option_type WHEN 'Call' THEN underlying_price - strike ELSE strike - underlying_price END, 0.0) AS inner_value
  FROM option_chain WHERE days_to_expiry > 0 AND underlying_price BETWEEN 0.3 * strike AND 5 * strike AND last_price > 0.01),
{solved_sql("q")},
a AS MATERIALIZED (SELECT *, {d1_sql("iv")} AS x1 FROM q_iv),
b AS MATERIALIZED (SELECT *, x1 - iv * sqrt(t) AS x2, exp(-x1 * x1 / 2.0) / sqrt(2.0 * pi()) AS pdf, strike * exp(-rate * t) AS fk FROM a),
c AS MATERIALIZED (SELECT *, {pricing.cdf_sql("x1")} AS n1, {pricing.cdf_sql("x2")} AS n2 FROM b),
d AS MATERIALIZED (SELECT *, {price_from("n1", "n2")} AS model FROM c),
e AS MATERIALIZED (SELECT *, coalesce(iv BETWEEN 0.05 AND 2.0 AND abs(model - paid) <= 0.01 * paid AND paid - inner_value >= -0.05, false) AS iv_ok,
       (-underlying_price * pdf * iv / (2.0 * sqrt(t)) + CASE option_type WHEN 'Call' THEN -rate * fk * n2 ELSE rate * fk * (1.0 - n2) END) / 365.0 AS decay, pdf / (underlying_price * iv * sqrt(t)) AS bend, underlying_price * pdf * sqrt(t) / 100.0 AS lift FROM d),
f AS (SELECT ticker, option_type, strike, expiry_date, trade_date, iv_ok, CASE WHEN iv_ok THEN iv END AS iv, CASE WHEN iv_ok THEN model END AS repriced, CASE WHEN iv_ok THEN n1 - CASE option_type WHEN 'Call' THEN 0.0 ELSE 1.0 END END AS delta, CASE WHEN iv_ok THEN CASE WHEN bend > 1 THEN 0.0 ELSE bend END END AS gamma,
       CASE WHEN iv_ok THEN CASE WHEN abs(decay) > model THEN 0.0 ELSE decay END END AS theta, CASE WHEN iv_ok THEN CASE WHEN lift > underlying_price THEN 0.0 ELSE lift END END AS vega, CASE WHEN iv_ok THEN t * fk / 100.0 * CASE option_type WHEN 'Call' THEN n2 ELSE n2 - 1.0 END END AS rho,
       CASE WHEN iv_ok THEN -pdf * x2 / iv / 100.0 END AS vanna, CASE WHEN iv_ok THEN -pdf * (2.0 * rate * t - x2 * iv * sqrt(t)) / (2.0 * t * iv * sqrt(t)) / 365.0 END AS charm FROM e)
SELECT {", ".join(c if n is None else f"round({c} + 3e-7, {n}) + 0.0 AS {c}" for c, n in FROM_PRICES.items())} FROM f"""),
)
def greeks_from_prices(spark, sf_dir):
    """Volatilities solved from last prices with all Greeks, each only where the volatility passes the gates."""
    out = priced(chain_of(spark, sf_dir).drop("delta", "gamma", "vega"))
    return select_rounded(out.withColumns({c: F.when(F.col("iv_ok"), F.col(c)) for c in ("iv", "repriced")}), FROM_PRICES).withColumns({c: F.col(c) + 0.0 for c in GREEKS})  # no negative zero


MODEL = dict.fromkeys(["ticker", "option_type", "strike", "expiry_date", "trade_date"]) | {"model_price": 4, "model_delta": 6, "model_gamma": 6, "model_vega": 6, "parity_gap": 6}
_C1 = pricing.cdf_sql("d1")
_C2 = pricing.cdf_sql("d2")


@register(
    "model_prices",
    adapters.doubles(f"""
WITH {CHAIN},
a AS MATERIALIZED (SELECT *, days_to_expiry / 365.0 AS t, least(greatest((ln(underlying_price / strike) + (0.03 + implied_volatility ** 2 / 2.0) * (days_to_expiry / 365.0)) / (implied_volatility * sqrt(days_to_expiry / 365.0)), -10.0), 10.0) AS d1 FROM option_chain WHERE days_to_expiry > 0),
b AS MATERIALIZED (SELECT *, d1 - implied_volatility * sqrt(t) AS d2, exp(-0.03 * t) AS disc, exp(-d1 * d1 / 2.0) / sqrt(2.0 * pi()) AS pdf FROM a),
c AS MATERIALIZED (SELECT *, {_C1} AS n1, {_C2} AS n2 FROM b),
d AS (SELECT *, greatest(underlying_price * n1 - strike * disc * n2, underlying_price - strike, 0.0) AS call, greatest(strike * disc * (1.0 - n2) - underlying_price * (1.0 - n1), strike - underlying_price, 0.0) AS put FROM c),
e AS (SELECT *, CASE option_type WHEN 'Call' THEN call ELSE put END AS model_price, CASE option_type WHEN 'Call' THEN n1 ELSE n1 - 1.0 END AS model_delta, pdf / (underlying_price * implied_volatility * sqrt(t)) AS model_gamma, underlying_price * pdf * sqrt(t) / 100.0 AS model_vega,
        underlying_price * n1 - strike * disc * n2 - (strike * disc * (1.0 - n2) - underlying_price * (1.0 - n1)) - (underlying_price - strike * disc) AS parity_gap FROM d)
SELECT {sql_rounded(MODEL)} FROM e"""),
)
def model_prices(spark, sf_dir):
    """Price and Greeks at the chain's own volatility, with put-call parity as a check."""
    s, k, t, r, kind, v = F.col("underlying_price"), F.col("strike"), F.col("days_to_expiry") / 365, F.lit(adapters.RATE), F.col("option_type"), F.col("implied_volatility")
    n1, n2, disc = pricing.norm_cdf(pricing.d1(s, k, t, r, v)), pricing.norm_cdf(pricing.d2(s, k, t, r, v)), F.exp(-r * t)
    gap = (s * n1 - k * disc * n2) - (k * disc * (1 - n2) - s * (1 - n1)) - (s - k * disc)
    out = chain_of(spark, sf_dir).where("days_to_expiry > 0").withColumns({"model_price": pricing.price(kind, s, k, t, r, v), "model_delta": pricing.delta(kind, s, k, t, r, v), "model_gamma": pricing.gamma(s, k, t, r, v), "model_vega": pricing.vega(s, k, t, r, v), "parity_gap": gap})
    return select_rounded(out, MODEL)


# Underlyings and the market overview


@register("dim_underlying", f"WITH {CHAIN} SELECT md5(ticker) AS underlying_id, ticker, min(trade_date) AS first_seen, max(trade_date) AS last_seen, arg_max(underlying_price, trade_date) AS last_price FROM option_chain GROUP BY ticker")
def dim_underlying(spark, sf_dir):
    return chain_of(spark, sf_dir).groupBy("ticker").agg(F.min("trade_date").alias("first_seen"), F.max("trade_date").alias("last_seen"), F.max_by("underlying_price", "trade_date").alias("last_price")).withColumn("underlying_id", F.md5("ticker"))


def market_overview(second: DataFrame) -> DataFrame:
    """Newest scrape of each contract summed per ticker and day; the previous day's price stands in for the open."""
    day = fact_eod(second).groupBy("ticker", "trade_date").agg(
        F.max("underlying_price").alias("close"), F.sum(F.when(F.col("option_type") == "Call", F.col("open_interest")).otherwise(0)).alias("total_oi_calls"), F.sum(F.when(F.col("option_type") == "Put", F.col("open_interest")).otherwise(0)).alias("total_oi_puts")
    )
    before = F.lag("close").over(Window.partitionBy("ticker").orderBy("trade_date"))
    return day.withColumns({"underlying_id": F.md5("ticker"), "open": before, "change_pct": safe_div(F.col("close") - before, before) * 100, "call_put_ratio": safe_div(F.col("total_oi_calls"), F.col("total_oi_puts"))})


OVERVIEW = dict.fromkeys(["underlying_id", "ticker", "trade_date", "open", "close", "total_oi_calls", "total_oi_puts"]) | {"change_pct": 6, "call_put_ratio": 6}


@register(
    "fact_market_overview",
    f"""
WITH {CHAIN},{SOURCES_CTE},
e AS (SELECT * FROM src2 QUALIFY row_number() OVER (PARTITION BY ticker, option_type, strike, expiry_date, trade_date ORDER BY scrape DESC) = 1),
d AS (SELECT ticker, trade_date, max(underlying_price) AS close, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Call'), 0) AS BIGINT) AS total_oi_calls, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Put'), 0) AS BIGINT) AS total_oi_puts FROM e GROUP BY 1, 2),
o AS (SELECT *, md5(ticker) AS underlying_id, lag(close) OVER w AS open, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) * 100 AS change_pct, total_oi_calls / nullif(total_oi_puts, 0) AS call_put_ratio FROM d WINDOW w AS (PARTITION BY ticker ORDER BY trade_date))
SELECT {sql_rounded(OVERVIEW)} FROM o""",
)
def fact_market_overview(spark, sf_dir):
    return select_rounded(market_overview(two_sources(chain_of(spark, sf_dir))[1]), OVERVIEW)


def timeseries(first: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the first source that are newer than what is known of their ticker, with intrinsic and time value."""
    high = known.groupBy("ticker").agg(F.max("trade_date").alias("known_to"))
    s, k = F.col("underlying_price"), F.col("strike")
    inner = F.greatest(F.when(F.col("option_type") == "Call", s - k).otherwise(k - s), F.lit(0.0))
    new = first.join(high, "ticker", "left").where(F.col("known_to").isNull() | (F.col("trade_date") > F.col("known_to")))
    return new.withColumns({"option_id": contract_id(*CONTRACT), "intrinsic_value": inner, "time_value": F.greatest(F.col("last_price") - inner, F.lit(0.0)), "mid_price": (F.col("bid") + F.col("ask")) / 2})


SERIES = dict.fromkeys(["option_id", "ticker", "trade_date"]) | {"intrinsic_value": 4, "time_value": 4, "mid_price": 6}


@register(
    "fact_option_timeseries",
    f"""
WITH {CHAIN},{SOURCES_CTE},
n AS (SELECT *, greatest(CASE option_type WHEN 'Call' THEN underlying_price - strike ELSE strike - underlying_price END, 0) AS intrinsic_value FROM src1 a WHERE NOT EXISTS (SELECT 1 FROM src2 k WHERE k.ticker = a.ticker AND k.trade_date >= a.trade_date AND k.trade_date < DATE '1997-01-01')),
s AS (SELECT {_ID} AS option_id, ticker, trade_date, intrinsic_value, greatest(last_price - intrinsic_value, 0) AS time_value, (bid + ask) / 2 AS mid_price FROM n)
SELECT {sql_rounded(SERIES)} FROM s""",
)
def fact_option_timeseries(spark, sf_dir):
    """What a run after 1996 would append, the rows up to then being known."""
    first, second = two_sources(chain_of(spark, sf_dir))
    return select_rounded(timeseries(first, second.where("trade_date < date'1997-01-01'")), SERIES)
