"""Reports over the option chain: current and changed open interest, volumes, ratios, strikes near the money, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_div, sum_if
from tidemark.operators.rows import latest_by, ranked, top_k
from tidemark.plans.gold_chain import CHAIN, chain_of, is_call, select_rounded, sql_rounded
from tidemark.plans.registry import register

KEY = ["ticker", "option_type", "strike", "expiry_date"]


def as_of(chain: DataFrame, days: int) -> DataFrame:
    """Rows of the last `days` days before the newest trade date, found by one aggregate that is joined as a single row."""
    newest = chain.agg(F.max("trade_date").alias("newest"))
    return chain.crossJoin(F.broadcast(newest)).where(F.col("trade_date") >= F.date_sub("newest", days)).drop("newest")


def current_oi(chain: DataFrame) -> DataFrame:
    return as_of(chain, 1).groupBy("ticker", "strike").agg(sum_if(is_call(), F.col("open_interest")).alias("call_oi"), sum_if(~is_call(), F.col("open_interest")).alias("put_oi"), F.sum("open_interest").alias("total_oi"))


@register(
    "report_current_oi",
    f"WITH {CHAIN} SELECT ticker, strike, CAST(sum(if(option_type = 'Call', open_interest, 0)) AS BIGINT) AS call_oi, CAST(sum(if(option_type = 'Put', open_interest, 0)) AS BIGINT) AS put_oi, CAST(sum(open_interest) AS BIGINT) AS total_oi "
    "FROM option_chain WHERE trade_date >= (SELECT max(trade_date) FROM option_chain) - 1 GROUP BY ticker, strike",
)
def report_current_oi(spark, sf_dir):
    return current_oi(chain_of(spark, sf_dir))


def oi_change(chain: DataFrame, days: int = 60) -> DataFrame:
    """Newest against oldest open interest of each contract within the last `days` days."""
    some = as_of(chain, days)
    new = latest_by(some, KEY, [F.desc("trade_date")]).select(*KEY, F.col("trade_date").alias("new_date"), F.col("open_interest").alias("new_oi"))
    old = latest_by(some, KEY, [F.asc("trade_date")]).select(*KEY, F.col("trade_date").alias("old_date"), F.col("open_interest").alias("old_oi"))
    both = new.join(old, KEY, "left").withColumn("change", F.col("new_oi") - F.col("old_oi"))
    return both.withColumn("change_pct", safe_div(F.col("change"), F.col("old_oi")) * 100)


CHANGE = dict.fromkeys([*KEY, "new_date", "new_oi", "old_date", "old_oi", "change"]) | {"change_pct": 4}


@register(
    "report_oi_change",
    f"WITH {CHAIN}, s AS (SELECT * FROM option_chain WHERE trade_date >= (SELECT max(trade_date) FROM option_chain) - 60), n AS (SELECT DISTINCT ON (ticker, option_type, strike, expiry_date) * FROM s ORDER BY ticker, option_type, strike, expiry_date, trade_date DESC), "
    "o AS (SELECT DISTINCT ON (ticker, option_type, strike, expiry_date) * FROM s ORDER BY ticker, option_type, strike, expiry_date, trade_date), "
    "j AS (SELECT n.ticker, n.option_type, n.strike, n.expiry_date, n.trade_date AS new_date, n.open_interest AS new_oi, o.trade_date AS old_date, o.open_interest AS old_oi, n.open_interest - o.open_interest AS change, (n.open_interest - o.open_interest) / nullif(o.open_interest, 0) * 100 AS change_pct "
    f"FROM n LEFT JOIN o USING (ticker, option_type, strike, expiry_date)) SELECT {sql_rounded(CHANGE)} FROM j",
)
def report_oi_change(spark, sf_dir):
    return select_rounded(oi_change(chain_of(spark, sf_dir)), CHANGE)


@register("report_volume_top50", f"WITH {CHAIN} SELECT ticker, option_type, strike, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS contracts FROM option_chain GROUP BY 1, 2, 3 HAVING sum(volume) > 0 ORDER BY total_volume DESC, ticker, option_type, strike LIMIT 50")
def report_volume_top50(spark, sf_dir):
    out = chain_of(spark, sf_dir).groupBy("ticker", "option_type", "strike").agg(F.sum("volume").alias("total_volume"), F.count("*").alias("contracts")).where("total_volume > 0")
    return out.orderBy(F.desc("total_volume"), "ticker", "option_type", "strike").limit(50)


RATIO = dict.fromkeys(["ticker", "expiry_date", "call_oi", "put_oi"]) | {"put_call_ratio": 6}


@register(
    "report_put_call_by_expiry",
    f"WITH {CHAIN}, s AS (SELECT ticker, expiry_date, CAST(sum(if(option_type = 'Call', open_interest, 0)) AS BIGINT) AS call_oi, CAST(sum(if(option_type = 'Put', open_interest, 0)) AS BIGINT) AS put_oi FROM option_chain GROUP BY 1, 2), r AS (SELECT *, put_oi / nullif(call_oi, 0) AS put_call_ratio FROM s) SELECT {sql_rounded(RATIO)} FROM r",
)
def report_put_call_by_expiry(spark, sf_dir):
    out = chain_of(spark, sf_dir).groupBy("ticker", "expiry_date").agg(sum_if(is_call(), F.col("open_interest")).alias("call_oi"), sum_if(~is_call(), F.col("open_interest")).alias("put_oi"))
    return select_rounded(out.withColumn("put_call_ratio", safe_div(F.col("put_oi"), F.col("call_oi"))), RATIO)


NEAR = dict.fromkeys(["ticker", "trade_date", "option_type", "strike", "expiry_date", "open_interest", "position"]) | {"distance_pct": 4}


@register(
    "report_near_money",
    f"WITH {CHAIN}, d AS (SELECT *, (strike - underlying_price) / underlying_price * 100 AS distance_pct FROM option_chain), p AS (SELECT *, CASE WHEN abs(distance_pct) < 2 THEN 'ATM' WHEN (option_type = 'Call') = (strike < underlying_price) THEN 'ITM' ELSE 'OTM' END AS position FROM d WHERE abs(distance_pct) <= 10) SELECT {sql_rounded(NEAR)} FROM p",
)
def report_near_money(spark, sf_dir):
    d = F.col("distance_pct")
    out = chain_of(spark, sf_dir).withColumn("distance_pct", safe_div(F.col("strike") - F.col("underlying_price"), F.col("underlying_price")) * 100).where(F.abs(d) <= 10)
    return select_rounded(out.withColumn("position", F.when(F.abs(d) < 2, "ATM").when(is_call() == (F.col("strike") < F.col("underlying_price")), "ITM").otherwise("OTM")), NEAR)


def atm_tracker(chain: DataFrame, radius: int = 2) -> DataFrame:
    """Of the two nearest expiries of each day the 2 * radius + 1 strikes nearest to spot, with changes to the contract's
    previous day."""
    near = chain.groupBy("ticker", "trade_date", "expiry_date").agg(F.count("*").alias("n"))
    near = top_k(near, ["ticker", "trade_date"], [F.asc("expiry_date")], 2, "expiry_rank").drop("n", "expiry_rank")
    strikes = chain.join(near, ["ticker", "trade_date", "expiry_date"], "left_semi").groupBy("ticker", "trade_date", "expiry_date", "strike").agg(
        F.max("underlying_price").alias("spot"), sum_if(is_call(), F.col("open_interest")).alias("call_oi"), sum_if(~is_call(), F.col("open_interest")).alias("put_oi"), F.sum("volume").alias("volume")
    )
    picked = ranked(strikes, ["ticker", "trade_date", "expiry_date"], [F.round(F.abs(F.col("strike") - F.col("spot")), 6), F.asc("strike")], "near_rank").where(F.col("near_rank") <= 2 * radius + 1)
    w = Window.partitionBy("ticker", "expiry_date", "strike").orderBy("trade_date")
    return picked.withColumns({"near_rank": F.col("near_rank").cast("long"), "call_oi_change": F.col("call_oi") - F.lag("call_oi").over(w), "put_oi_change": F.col("put_oi") - F.lag("put_oi").over(w), "volume_change": F.col("volume") - F.lag("volume").over(w)})


@register(
    "report_atm_tracker",
    f"""
WITH {CHAIN},
n AS (SELECT ticker, trade_date, expiry_date FROM (SELECT DISTINCT ticker, trade_date, expiry_date FROM option_chain) QUALIFY row_number() OVER (PARTITION BY ticker, trade_date ORDER BY expiry_date) <= 2),
s AS (SELECT ticker, trade_date, expiry_date, strike, max(underlying_price) AS spot, CAST(sum(if(option_type = 'Call', open_interest, 0)) AS BIGINT) AS call_oi, CAST(sum(if(option_type = 'Put', open_interest, 0)) AS BIGINT) AS put_oi, CAST(sum(volume) AS BIGINT) AS volume
      FROM option_chain SEMI JOIN n USING (ticker, trade_date, expiry_date) GROUP BY 1, 2, 3, 4),
p AS (SELECT *, row_number() OVER (PARTITION BY ticker, trade_date, expiry_date ORDER BY round(abs(strike - spot), 6), strike) AS near_rank FROM s QUALIFY near_rank <= 5)
SELECT *, call_oi - lag(call_oi) OVER w AS call_oi_change, put_oi - lag(put_oi) OVER w AS put_oi_change, volume - lag(volume) OVER w AS volume_change FROM p WINDOW w AS (PARTITION BY ticker, expiry_date, strike ORDER BY trade_date)""",
)
def report_atm_tracker(spark, sf_dir):
    return atm_tracker(chain_of(spark, sf_dir))


FRIDAY = dict.fromkeys(["ticker", "trade_date", "option_type", "strike", "expiry_date", "open_interest", "oi_change", "change_rank"])


@register(
    "report_friday_changes",
    f"WITH {CHAIN}, f AS (SELECT *, open_interest - lag(open_interest) OVER (PARTITION BY ticker, option_type, strike, expiry_date ORDER BY trade_date) AS oi_change FROM option_chain WHERE dayofweek(trade_date) = 5), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY ticker, trade_date ORDER BY abs(oi_change) DESC, option_type, strike, expiry_date) AS change_rank FROM f WHERE oi_change IS NOT NULL QUALIFY change_rank <= 10) "
    f"SELECT {sql_rounded(FRIDAY)} FROM r",
)
def report_friday_changes(spark, sf_dir):
    """The ten largest week-over-week changes of each Friday."""
    w = Window.partitionBy(*KEY).orderBy("trade_date")
    rows = chain_of(spark, sf_dir).where(F.dayofweek("trade_date") == 6).withColumn("oi_change", F.col("open_interest") - F.lag("open_interest").over(w)).where("oi_change is not null")
    out = top_k(rows, ["ticker", "trade_date"], [F.desc(F.abs("oi_change")), F.asc("option_type"), F.asc("strike"), F.asc("expiry_date")], 10, "change_rank")
    return select_rounded(out.withColumn("change_rank", F.col("change_rank").cast("long")), FRIDAY)


QUALITY = dict.fromkeys(["ticker", "rows", "days", "null_bids", "null_volumes", "bad_prices", "verdict"]) | {"bid_coverage": 6}


@register(
    "report_quality",
    f"WITH {CHAIN}, q AS (SELECT ticker, count(*) AS rows, count(DISTINCT trade_date) AS days, count(*) FILTER (bid IS NULL) AS null_bids, count(*) FILTER (volume IS NULL) AS null_volumes, count(*) FILTER (last_price < 0 OR underlying_price <= 0) AS bad_prices, count(bid) / count(*) AS bid_coverage FROM option_chain GROUP BY ticker), "
    f"v AS (SELECT *, CASE WHEN rows < 100 THEN 'FAIL' WHEN bid_coverage < 0.8 OR bad_prices > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM q) SELECT {sql_rounded(QUALITY)} FROM v",
)
def report_quality(spark, sf_dir):
    """Counts and coverage of each ticker with a verdict, in one aggregate."""
    out = chain_of(spark, sf_dir).groupBy("ticker").agg(
        F.count("*").alias("rows"), F.count_distinct("trade_date").alias("days"), F.count(F.when(F.col("bid").isNull(), 1)).alias("null_bids"), F.count(F.when(F.col("volume").isNull(), 1)).alias("null_volumes"),
        F.count(F.when((F.col("last_price") < 0) | (F.col("underlying_price") <= 0), 1)).alias("bad_prices"), (F.count("bid") / F.count("*")).alias("bid_coverage"),
    )
    return select_rounded(out.withColumn("verdict", F.when(F.col("rows") < 100, "FAIL").when((F.col("bid_coverage") < 0.8) | (F.col("bad_prices") > 0), "WARN").otherwise("PASS")), QUALITY)


PRESETS = {
    "top_oi": "SELECT ticker, option_type, strike, expiry_date, open_interest FROM option_chain ORDER BY open_interest DESC LIMIT 20",
    "expiries": "SELECT ticker, expiry_date, count(*) AS contracts, sum(open_interest) AS total_oi FROM option_chain GROUP BY ticker, expiry_date ORDER BY ticker, expiry_date",
    "daily_totals": "SELECT ticker, trade_date, sum(volume) AS volume, sum(open_interest) AS total_oi FROM option_chain GROUP BY ticker, trade_date",
}


def ask(spark, sf_dir: str, query: str, **args) -> DataFrame:
    """A preset by name, or SQL text over the view {option_chain} with bound parameters."""
    text = PRESETS.get(query, query).replace("FROM option_chain", "FROM {option_chain}")
    return spark.sql(text, args=args or None, option_chain=chain_of(spark, sf_dir))
