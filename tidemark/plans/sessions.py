"""Trading sessions, universes and time: session hours over time zones, cool-down, z-scores, liquidity, snapshots, days, and
what an entry would have cost."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import is_double_time, is_gap_time
from tidemark.functions.numbers import safe_div
from tidemark.operators.rows import ranked
from tidemark.operators.series import numbered, streamed
from tidemark.plans.events import hourly
from tidemark.plans.gold_chain import select_rounded, sql_rounded
from tidemark.plans.registry import ORACLES, QUERIES, register
from tidemark.session import table
from tidemark.sources import adapters

HOME, COOLDOWN_HOURS = "Europe/Amsterdam", 40
# The market that stands for each event type, and each market's zone, first and last minute of its session.
MARKETS = {"click": "US", "view": "NL", "purchase": "UK", "signup": "DE"}
HOURS = {"US": ("America/New_York", 570, 959)} | {m: (HOME, 540, 1050) for m in ("NL", "UK", "FR", "DE")}
HOURLY = adapters.oracle("bars_hourly")


def market(ticker: Column) -> Column:
    """The market of an event type; null where none has a rule."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for t, m in MARKETS.items():
        out = out.when(ticker == t, m)
    return out


def in_session(at: Column, market_: Column, home: str = HOME) -> Column:
    """Whether a home-zone time lies within its market's hours. Times that the home zone skips or has twice, and markets
    without hours, are in none."""
    out = F.when(is_gap_time(at, home) | is_double_time(at, home), False)
    for name, (zone, first, last) in HOURS.items():
        there = at if zone == home else F.from_utc_timestamp(F.to_utc_timestamp(at, home), zone)
        out = out.when(market_ == name, (F.hour(there) * 60 + F.minute(there)).between(first, last))
    return F.coalesce(out.otherwise(False), F.lit(False))


def of_universe(df: DataFrame, tickers: list[str] | None, column: str = "ticker") -> DataFrame:
    """Rows of an explicit list of tickers, or all."""
    return df if tickers is None else df.where(F.col(column).isin(tickers))


_MARKET = "CASE ticker " + " ".join(f"WHEN '{t}' THEN '{m}'" for t, m in MARKETS.items()) + " END"
_MINUTE = "hour({0}) * 60 + minute({0})"
_NY = f"timezone('America/New_York', timezone('{HOME}', ts))"
SESSION_CTE = f"""
sb AS (SELECT *, {_MARKET} AS market, timezone('{HOME}', ts) AS utc FROM bars_hourly),
sk AS (SELECT * FROM sb WHERE timezone('{HOME}', utc) = ts AND timezone('{HOME}', utc + INTERVAL 1 HOUR) <> ts AND timezone('{HOME}', utc - INTERVAL 1 HOUR) <> ts
       AND ((market = 'US' AND {_MINUTE.format(_NY)} BETWEEN 570 AND 959) OR (market IN ('NL', 'UK', 'FR', 'DE') AND {_MINUTE.format("ts")} BETWEEN 540 AND 1050)))"""


@register("session_bars", f"WITH {HOURLY},{SESSION_CTE} SELECT market, ticker, ts, round(close + 3e-7, 4) AS close, volume FROM sk")
def session_bars(spark, sf_dir):
    """Hourly bars within their market's session, read as home-zone times."""
    bars = hourly(spark, sf_dir).withColumn("market", market(F.col("ticker")))
    kept = bars.where(in_session(F.col("ts").cast("timestamp"), F.col("market")))
    return kept.select("market", "ticker", "ts", F.round(F.col("close") + 3e-7, 4).alias("close"), "volume")


# Features and events


def z_scores(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Adds <column>_norm: distance from the key's mean in its spreads."""
    w = Window.partitionBy(key)
    return df.withColumns({f"{c}_norm": (F.col(c) - F.avg(c).over(w)) / (F.when(F.count(c).over(w) > 1, F.stddev_samp(c).over(w)) + 1e-9) for c in columns})


NORMED = ["range_pct", "up_volume_share", "effort_result", "clv_mean", "pos_end", "top_quartile_share", "bottom_quartile_share"]
NORMS = {"ticker": None, "t_end": None} | {f"{c}_norm": 4 for c in NORMED}


@register(
    "normalised_features",
    f"WITH f AS ({ORACLES['event_window_features']}), z AS (SELECT ticker, t_end, "
    + ", ".join(f"({c} - avg({c}) OVER w) / (CASE WHEN count({c}) OVER w > 1 THEN stddev_samp({c}) OVER w END + 1e-9) AS {c}_norm" for c in NORMED)
    + f" FROM f WINDOW w AS (PARTITION BY ticker)) SELECT {sql_rounded(NORMS)} FROM z",
)
def normalised_features(spark, sf_dir):
    return select_rounded(z_scores(QUERIES["event_window_features"](spark, sf_dir), "ticker", NORMED), NORMS)


def cooled(events: DataFrame, key: str, at: str, hours: float = COOLDOWN_HOURS) -> DataFrame:
    """Events at least so many hours after the last one kept of their key; the first is kept."""
    place = events.columns.index(at)

    def work(state: dict, rows) -> list:
        keep, last = [], state.get("last")
        for t in rows.column(place).to_pylist():
            keep.append(last is None or t - last >= dt.timedelta(hours=hours))
            last = t if keep[-1] else last
        state["last"] = last
        return [pa.array(keep)]

    return streamed(events, key, at, "_keep boolean", work).where("_keep").drop("_keep")


@register(
    "cooled_events",
    f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT ticker, t_end, label FROM ({ORACLES["consolidation_events"]})),
k AS (SELECT ticker, min(t_end) AS t_end FROM e GROUP BY ticker
      UNION ALL SELECT e.ticker, min(e.t_end) FROM k JOIN e ON e.ticker = k.ticker AND e.t_end >= k.t_end + INTERVAL {COOLDOWN_HOURS} HOUR GROUP BY e.ticker)
SELECT ticker, t_end, label FROM k JOIN e USING (ticker, t_end)""",
)
def cooled_events(spark, sf_dir):
    return cooled(QUERIES["consolidation_events"](spark, sf_dir).select("ticker", "t_end", "label"), "ticker", "t_end")


# Universes

LIQUIDITY = {"ticker": None, "n_bars": None, "mean_volume": 6, "mean_spread": 6}
LIQUIDITY_CTE = "lq AS (SELECT ticker, count(*) AS n_bars, avg(volume) AS mean_volume, avg((high - low) / nullif(close, 0)) AS mean_spread FROM bars_hourly GROUP BY ticker)"


def liquidity(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.count("*").alias("n_bars"), F.avg("volume").alias("mean_volume"), F.avg(safe_div(F.col("high") - F.col("low"), F.col("close"))).alias("mean_spread"))


@register("liquidity_profile", f"WITH {HOURLY},{LIQUIDITY_CTE} SELECT {sql_rounded(LIQUIDITY)} FROM lq")
def liquidity_profile(spark, sf_dir):
    return select_rounded(liquidity(hourly(spark, sf_dir)), LIQUIDITY)


def universes(profile: DataFrame, listed: list[str], most_liquid: int = 3, drop_widest: int = 1) -> DataFrame:
    """Rows (universe, ticker): all tickers, a list, the most liquid ones, all but those of the widest bars."""
    wide = ranked(profile.withColumn("_all", F.lit(1)), ["_all"], [F.desc(F.round("mean_volume", 6)), "ticker"], "by_volume")  # one row a ticker
    wide = ranked(wide, ["_all"], [F.desc(F.round("mean_spread", 9)), "ticker"], "by_spread")
    member = lambda name, cond: F.when(cond, F.lit(name))
    names = F.array_compact(F.array(member("all", F.lit(True)), member("listed", F.col("ticker").isin(listed)), member("liquid", F.col("by_volume") <= most_liquid), member("narrow", F.col("by_spread") > drop_widest)))
    return wide.select(F.explode(names).alias("universe"), "ticker")


VARIANT = {"universe": None, "n_tickers": None, "n_trades": None, "win_rate": 4, "mean_pct": 4, "total_eur": 2}


@register(
    "universe_variants",
    f"""
WITH {HOURLY},{LIQUIDITY_CTE},
q AS (SELECT ticker, row_number() OVER (ORDER BY round(mean_volume, 6) DESC, ticker) AS bv, row_number() OVER (ORDER BY round(mean_spread, 9) DESC, ticker) AS bs FROM lq),
u AS (SELECT 'all' AS universe, ticker FROM q UNION ALL SELECT 'listed', ticker FROM q WHERE ticker IN ('click', 'view') UNION ALL SELECT 'liquid', ticker FROM q WHERE bv <= 3 UNION ALL SELECT 'narrow', ticker FROM q WHERE bs > 1),
t AS ({ORACLES["event_trades"]}),
v AS (SELECT universe, count(DISTINCT t.ticker) AS n_tickers, count(*) AS n_trades, avg(if(pnl_eur > 0, 1, 0)) * 100 AS win_rate, avg(pnl_pct) AS mean_pct, sum(pnl_eur) AS total_eur FROM u JOIN t USING (ticker) WHERE pnl_pct IS NOT NULL GROUP BY universe)
SELECT {sql_rounded(VARIANT)} FROM v""",
)
def universe_variants(spark, sf_dir):
    """Results of the same trades in several universes; universes hold one row a ticker."""
    done = QUERIES["event_trades"](spark, sf_dir).where("pnl_pct is not null")
    rows = universes(liquidity(hourly(spark, sf_dir)), ["click", "view"]).join(done, "ticker")
    out = rows.groupBy("universe").agg(
        F.count_distinct("ticker").alias("n_tickers"), F.count("*").alias("n_trades"), (F.avg((F.col("pnl_eur") > 0).cast("double")) * 100).alias("win_rate"), F.avg("pnl_pct").alias("mean_pct"), F.sum("pnl_eur").alias("total_eur")
    )
    return select_rounded(out, VARIANT)


# Snapshots and days


@register(
    "snapshot_hours",
    f"""
WITH {HOURLY},
h AS (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS BIGINT) AS hour, count(DISTINCT ticker) AS tickers, CAST(sum(volume) AS BIGINT) AS n FROM bars_hourly GROUP BY 1, 2),
m AS (SELECT *, max(tickers) OVER (PARTITION BY day) AS most FROM h)
SELECT day, count(*) AS hours_with_data, min(hour) AS first_hour, max(hour) AS last_hour, max(hour) FILTER (tickers = most) AS last_complete_hour, arg_max(n, hour) AS rows_in_last, CAST(sum(n) AS BIGINT) AS rows_in_day FROM m GROUP BY day""",
)
def snapshot_hours(spark, sf_dir):
    """Per day the hours with data, and the last one in which as many tickers were seen as in any hour of the day."""
    hours = hourly(spark, sf_dir).groupBy(F.to_date("ts").alias("day"), F.hour("ts").cast("long").alias("hour")).agg(F.count_distinct("ticker").alias("tickers"), F.sum("volume").alias("n"))
    marked = hours.withColumn("most", F.max("tickers").over(Window.partitionBy("day")))
    return marked.groupBy("day").agg(
        F.count("*").alias("hours_with_data"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"), F.max(F.when(F.col("tickers") == F.col("most"), F.col("hour"))).alias("last_complete_hour"), F.max_by("n", "hour").alias("rows_in_last"), F.sum("n").alias("rows_in_day")
    )


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of days (date_value); days of the week count from Monday = 0."""
    d = F.col("date_value")
    text = lambda f: F.date_format(d, f)
    long = lambda c: c.cast("long")
    last = F.last_day(d)
    iso_year = F.year(F.date_add(F.trunc(d, "week"), 3))
    return days.select(
        long(text("yyyyMMdd")).alias("date_key"), "date_value", long(F.year(d)).alias("year"), long(F.quarter(d)).alias("quarter"), F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"), F.concat(text("yyyy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        long(F.month(d)).alias("month"), text("MMMM").alias("month_name"), text("MMM").alias("month_short"), text("yyyy-MM").alias("year_month"), long(F.weekofyear(d)).alias("week_of_year"), F.concat(iso_year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")).alias("year_week"),
        long(F.dayofmonth(d)).alias("day_of_month"), long(F.weekday(d)).alias("day_of_week"), text("EEEE").alias("day_name"), text("EEE").alias("day_short"), long(F.dayofyear(d)).alias("day_of_year"), (F.weekday(d) < 5).alias("is_weekday"), (F.weekday(d) >= 5).alias("is_weekend"), (d == last).alias("is_month_end"),
        ((d == last) & (F.month(d) % 3 == 0)).alias("is_quarter_end"), ((d == last) & (F.month(d) == 12)).alias("is_year_end"), text("yyyy-MM-dd").alias("date_display"), text("EEEE, MMMM d, yyyy").alias("date_display_long"),
    )


@register(
    "dim_date",
    """
WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
s AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM r)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS date_value, year(d) AS year, quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name, year(d) || '-Q' || quarter(d) AS year_quarter, month(d) AS month, monthname(d) AS month_name, strftime(d, '%b') AS month_short,
       strftime(d, '%Y-%m') AS year_month, weekofyear(d) AS week_of_year, isoyear(d) || '-W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS year_week, day(d) AS day_of_month, isodow(d) - 1 AS day_of_week, dayname(d) AS day_name, strftime(d, '%a') AS day_short, dayofyear(d) AS day_of_year,
       isodow(d) < 6 AS is_weekday, isodow(d) > 5 AS is_weekend, d = last_day(d) AS is_month_end, d = last_day(d) AND month(d) % 3 = 0 AS is_quarter_end, d = last_day(d) AND month(d) = 12 AS is_year_end, strftime(d, '%Y-%m-%d') AS date_display, dayname(d) || ', ' || monthname(d) || ' ' || day(d) || ', ' || year(d) AS date_display_long
FROM s""",
)
def dim_date_query(spark, sf_dir):
    span = table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return dim_date(span.select(F.explode(F.sequence("a", "b")).alias("date_value")))


# What an entry would have cost

REALISM = {"scenario": None, "n_trades": None, "win_rate": 4, "mean_pct": 4, "total_eur": 2}


@register(
    "entry_realism",
    f"""
WITH {HOURLY},
b AS (SELECT *, row_number() OVER w AS idx FROM bars_hourly WHERE high >= low AND low > 0 WINDOW w AS (PARTITION BY ticker ORDER BY ts)),
t AS (SELECT *, CASE side WHEN 'LONG' THEN 1.0 ELSE -1.0 END AS d FROM ({ORACLES["event_trades"]}) WHERE pnl_pct IS NOT NULL),
e AS (SELECT t.*, n.open, n.high, n.low, n.close FROM t JOIN b ON b.ticker = t.ticker AND b.ts = t.t_end JOIN b n ON n.ticker = t.ticker AND n.idx = b.idx + 1),
s AS (SELECT 'open' AS scenario, d, exit_price, open AS price FROM e UNION ALL SELECT 'typical', d, exit_price, (high + low + close) / 3 FROM e UNION ALL SELECT 'close', d, exit_price, close FROM e UNION ALL SELECT 'slipped', d, exit_price, open * (1 + d * 0.0005) FROM e),
p AS (SELECT *, d * (exit_price / price - 1) * 100 AS pnl FROM s),
r AS (SELECT scenario, count(*) AS n_trades, avg(if(100 * pnl > 10, 1, 0)) * 100 AS win_rate, avg(pnl) AS mean_pct, sum(100 * pnl - 10) AS total_eur FROM p GROUP BY scenario)
SELECT {sql_rounded(REALISM)} FROM r""",
)
def entry_realism(spark, sf_dir):
    """The closed trades with the same exits, entered at other prices of the first bar."""
    scenarios = {"open": F.col("open"), "typical": (F.col("high") + F.col("low") + F.col("close")) / 3, "close": F.col("close"), "slipped": F.col("open") * (1 + F.col("d") * 0.0005)}
    bars = hourly(spark, sf_dir)
    b = numbered(bars.where("high >= low and low > 0"), "ticker", "ts")
    nxt = b.select("ticker", (F.col("idx") - 1).alias("idx"), "open", "high", "low", "close")
    done = QUERIES["event_trades"](spark, sf_dir).where("pnl_pct is not null").withColumn("d", F.when(F.col("side") == "LONG", 1.0).otherwise(-1.0))
    e = done.join(b.select("ticker", F.col("ts").alias("t_end"), "idx"), ["ticker", "t_end"]).join(nxt, ["ticker", "idx"])
    spread = e.select("d", "exit_price", F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), c.alias("price")) for n, c in scenarios.items()])).alias("s"))
    pnl = spread.select("s.scenario", (F.col("d") * (F.col("exit_price") / F.col("s.price") - 1) * 100).alias("pnl"))
    out = pnl.groupBy("scenario").agg(F.count("*").alias("n_trades"), (F.avg((100 * F.col("pnl") > 10).cast("double")) * 100).alias("win_rate"), F.avg("pnl").alias("mean_pct"), F.sum(100 * F.col("pnl") - 10).alias("total_eur"))
    return select_rounded(out, REALISM)


# Signals for display

SIGNAL = {"ticker": None, "t_end": None, "side": None, "market": None, "currency": None, "confidence": None, "in_session": None, "flags": None, "p_up": 6, "limit_price": 4, "target_price": 4, "stop_price": 4}


@register(
    "signal_board",
    f"""
WITH {HOURLY},{SESSION_CTE},
s AS (SELECT t.*, {_MARKET.replace("CASE ticker", "CASE t.ticker")} AS market, b.close AS last FROM ({ORACLES["event_trades"]}) t JOIN bars_hourly b ON b.ticker = t.ticker AND b.ts = t.t_end),
x AS (SELECT *, CASE WHEN side = 'LONG' THEN 1.0 ELSE -1.0 END AS d, greatest(p_up, 1 - p_up) AS sure FROM s),
y AS (SELECT x.ticker, x.t_end, side, x.market, CASE x.market WHEN 'US' THEN 'USD' WHEN 'UK' THEN 'GBP' ELSE 'EUR' END AS currency, CASE WHEN sure >= 0.85 THEN 'HIGH' WHEN sure >= 0.75 THEN 'MEDIUM' ELSE 'LOW' END AS confidence, sk.ts IS NOT NULL AS in_session, p_up,
        entry * (1 + d * 0.0005) AS limit_price, entry * (1 + d * 0.015) AS target_price, entry * (1 - d * 0.01) AS stop_price,
        concat_ws(',', CASE WHEN x.market IS NULL THEN 'no market' END, CASE WHEN abs(entry / last - 1) > 0.02 THEN 'gap' END, CASE WHEN exit_type = 'OPEN' THEN 'open' END, CASE WHEN sure < 0.6 THEN 'weak' END) AS flags
      FROM x LEFT JOIN sk ON sk.ticker = x.ticker AND sk.ts = x.t_end)
SELECT {sql_rounded(SIGNAL)} FROM y""",
)
def signal_board(spark, sf_dir):
    """Signals with market, currency, confidence, session validity, quality flags and an exit plan around a limit five basis
    points beyond the entry."""
    last = hourly(spark, sf_dir).select("ticker", F.col("ts").alias("t_end"), F.col("close").alias("last"))
    x = QUERIES["event_trades"](spark, sf_dir).join(last, ["ticker", "t_end"]).withColumns({"market": market(F.col("ticker")), "d": F.when(F.col("side") == "LONG", 1.0).otherwise(-1.0), "sure": F.greatest(F.col("p_up"), 1 - F.col("p_up"))})
    e, d, sure = F.col("entry"), F.col("d"), F.col("sure")
    flags = F.array(F.when(F.col("market").isNull(), "no market"), F.when(F.abs(e / F.col("last") - 1) > 0.02, "gap"), F.when(F.col("exit_type") == "OPEN", "open"), F.when(sure < 0.6, "weak"))
    out = x.withColumns({
        "currency": F.when(F.col("market") == "US", "USD").when(F.col("market") == "UK", "GBP").otherwise("EUR"), "confidence": F.when(sure >= 0.85, "HIGH").when(sure >= 0.75, "MEDIUM").otherwise("LOW"), "in_session": in_session(F.col("t_end").cast("timestamp"), F.col("market")),
        "flags": F.array_join(F.array_compact(flags), ","), "limit_price": e * (1 + d * 0.0005), "target_price": e * (1 + d * 0.015), "stop_price": e * (1 - d * 0.01),
    })
    return select_rounded(out, SIGNAL)

