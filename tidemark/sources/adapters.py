"""Market tables out of the given star schema, so that every model runs on data that grows with it.

Each view is SQL text that Spark and the oracle's engine both read: option chains from line items and parts, daily bars per
brand, hourly bars per event type, and event calendars from orders.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.pricing import cdf_sql

RATE = 0.03
_D1 = f"((ln(underlying_price / strike) + ({RATE} + implied_volatility * implied_volatility / 2.0) * years) / (implied_volatility * sqrt(years)))"
_PDF = "(exp(-d1 * d1 / 2.0) / sqrt(2.0 * pi()))"
_PRICE = f"(underlying_price * {cdf_sql('d1')} - strike * exp(-{RATE} * years) * {cdf_sql('(d1 - implied_volatility * sqrt(years))')})"


def _date(engine: str, base: str, days: str) -> str:
    return f"date_add({base}, CAST({days} AS INT))" if engine == "spark" else f"({base} + CAST({days} AS INTEGER))"


def _chain(engine: str) -> str:
    """One row per contract and day: prices, quotes, open interest, Greeks; keys ticker, type, strike, expiry, trade date."""
    day = "CAST(l_shipdate AS DATE)"
    monday = "CAST(date_trunc('week', l_shipdate) AS DATE)"
    first = f"CAST(date_trunc('month', {_date(engine, 'monday', '35 + 60 * (l_linenumber % 2)')}) AS DATE)"
    dow = "(dayofweek(first) - 1)" if engine == "spark" else "dayofweek(first)"
    kept = "" if engine == "spark" else "MATERIALIZED"  # keeps the oracle from writing each nested formula out again
    between = "datediff(expiry_date, trade_date)" if engine == "spark" else "(expiry_date - trade_date)"
    return f"""
  chain_lines AS (
    SELECT p_type AS ticker, {monday} AS monday, {_date(engine, monday, "3 + l_linenumber % 3")} AS trade_date, l_linenumber,
           CASE WHEN l_returnflag = 'A' THEN 'Call' WHEN l_returnflag = 'R' THEN 'Put' WHEN l_orderkey % 2 = 0 THEN 'Call' ELSE 'Put' END AS option_type,
           CAST(80 + p_size % 31 AS DOUBLE) AS strike, CAST(l_quantity AS BIGINT) AS quantity, l_discount, l_tax,
           CAST(round(p_retailprice * 100) AS BIGINT) AS cents
    FROM lineitem JOIN part ON l_partkey = p_partkey),
  chain_months AS (SELECT *, {first} AS first FROM chain_lines),
  chain_expiries AS (SELECT *, {_date(engine, "first", f"(19 - {dow}) % 7 + 14")} AS expiry_date FROM chain_months),
  chain_rows AS (
    SELECT ticker, monday, trade_date, option_type, strike, expiry_date, CAST(sum(quantity) * 10 AS BIGINT) AS open_interest,
           CAST(sum(quantity) AS BIGINT) AS volume, 0.15 + max(l_discount) AS implied_volatility, max(l_tax) AS tax, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS lines
    FROM chain_expiries GROUP BY ticker, monday, trade_date, option_type, strike, expiry_date),
  chain_priced AS (
    SELECT *, round(CAST(sum(cents) OVER week AS DOUBLE) / sum(lines) OVER week / 1000.0, 2) AS underlying_price, CAST({between} AS BIGINT) AS days_to_expiry, {between} / 365.0 AS years
    FROM chain_rows WINDOW week AS (PARTITION BY ticker, monday)),
  chain_d1 AS {kept} (SELECT *, CAST({_D1} AS DOUBLE) AS d1 FROM chain_priced),
  chain_quotes AS {kept} (
    SELECT *, {cdf_sql("d1")} - CASE WHEN option_type = 'Call' THEN 0.0 ELSE 1.0 END AS delta, {_PDF} / (underlying_price * implied_volatility * sqrt(years)) AS gamma,
           underlying_price * {_PDF} * sqrt(years) / 100.0 AS vega,
           round({_PRICE} - CASE WHEN option_type = 'Call' THEN 0.0 ELSE underlying_price - strike * exp(-{RATE} * years) END + 0.00000003, 4) AS last_price
    FROM chain_d1),
  option_chain AS (
    SELECT ticker, trade_date, option_type, strike, expiry_date, open_interest, volume, implied_volatility, underlying_price, days_to_expiry, delta, gamma, vega, last_price,
           CASE WHEN tax < 0.07 THEN round(last_price * 0.98 + 0.00000003, 4) END AS bid, round(last_price * 1.02 + 0.00000003, 4) AS ask, underlying_price / strike AS moneyness, tax < 0.08 AS greeks_valid,
           open_interest > 300 AS is_liquid
    FROM chain_quotes)"""


def _daily(engine: str) -> str:
    """Daily bars per brand with the first and last price by a fixed order within the day."""
    tie = "struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)" if engine == "spark" else "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
    low, high = ("min_by", "max_by") if engine == "spark" else ("arg_min", "arg_max")
    return f"""
  daily_prices AS (
    SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trade_date, l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS quantity, {tie} AS tie
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 0),
  bars_daily AS (
    SELECT ticker, trade_date, {low}(price, tie) AS open, max(price) AS high, min(price) AS low, {high}(price, tie) AS close, CAST(sum(quantity) AS BIGINT) AS volume
    FROM daily_prices GROUP BY ticker, trade_date)"""


def _hourly(engine: str) -> str:
    """Hourly bars per event type around a level of 100; an hour's volume is its number of events."""
    low, high = ("min_by", "max_by") if engine == "spark" else ("arg_min", "arg_max")
    return f"""
  bars_hourly AS (
    SELECT event_type AS ticker, date_trunc('hour', ts) AS ts, {low}(100 + value / 50.0, ts) AS open, max(100 + value / 50.0) AS high, min(100 + value / 50.0) AS low,
           {high}(100 + value / 50.0, ts) AS close, CAST(count(*) AS BIGINT) AS volume
    FROM events GROUP BY event_type, date_trunc('hour', ts))"""


def _calendar(engine: str) -> str:
    """Earnings and ex-dividend days per brand out of two order priorities."""
    brands = "concat('Brand#', CAST(1 + o_custkey % 5 AS STRING), CAST(1 + o_orderkey % 5 AS STRING))" if engine == "spark" else "concat('Brand#', CAST(1 + o_custkey % 5 AS VARCHAR), CAST(1 + o_orderkey % 5 AS VARCHAR))"
    return f"""
  calendar_earnings AS (SELECT DISTINCT {brands} AS ticker, CAST(o_orderdate AS DATE) AS earnings_date FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderkey % 3 = 0),
  calendar_dividends AS (
    SELECT {brands} AS ticker, CAST(o_orderdate AS DATE) AS ex_dividend_date, max(round(o_totalprice / 100000.0, 4)) AS amount
    FROM orders WHERE o_orderpriority LIKE '5%' AND o_orderkey % 3 = 1 GROUP BY 1, 2)"""


def _curve(engine: str) -> str:
    """Interest rates by date and term (0 .. 4), with gaps, out of orders."""
    return """
  curve_points AS (
    SELECT CAST(o_orderdate AS DATE) AS curve_date, CAST(o_custkey % 5 AS BIGINT) AS term, round(avg(0.01 + (CAST(floor(o_totalprice) AS BIGINT) % 400) / 10000.0) + 0.000000003, 6) AS rate
    FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1, 2)"""


def doubles(text: str) -> str:
    """SQL text with its decimal literals as doubles, which both engines read alike."""
    return re.sub(r"(?<![\w.])(\d+\.\d+)(?![\dE])", r"\1E0", text)


VIEWS = {
    "option_chain": (_chain, ("lineitem", "part")),
    "bars_daily": (_daily, ("lineitem", "part")),
    "bars_hourly": (_hourly, ("events",)),
    "calendar_earnings": (_calendar, ("orders",)),
    "calendar_dividends": (_calendar, ("orders",)),
    "curve_points": (_curve, ("orders",)),
}


def oracle(*names: str) -> str:
    """Common table expressions of the named views for the oracle, to follow WITH."""
    return ",".join(dict.fromkeys(doubles(VIEWS[n][0]("duckdb")) for n in names))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables at sf_dir."""
    build, tables = VIEWS[name]
    args = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    text = doubles(build("spark"))
    for t in tables:
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {t} ", f"{word} {{{t}}} ")
    return spark.sql(f"WITH {text} SELECT * FROM {name}", **args)
