"""What comes in, over the given tables: pages and texts written and read back, late and repeated rows, dates filled from
another source, and daily summaries kept as partial states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import dow0, fiscal_quarter
from tidemark.functions.numbers import half_step, interpolate, safe_div
from tidemark.functions.text import market_of, parse_date, parse_expiry, parse_percent
from tidemark.operators import sketches
from tidemark.operators.rows import continue_ids, filled_from, insert_absent, replace_range, upsert, with_dense_ids
from tidemark.plans.gold_chain import CHAIN, chain_of, select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.session import table
from tidemark.sources import io


def dutch(x: Column, digits: int = 2) -> Column:
    return F.translate(F.format_number(x, digits), ",.", ".,")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df's rows spread evenly by a unique key over as many tasks as shuffles have. Texts are dear to write and parse, while their
    rows are so small that a million lie in one row group of a file, which is one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


@register(
    "price_pages",
    """
SELECT p_partkey, p_name AS name, 'NL' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isin, round(p_retailprice, 2) AS last, CASE WHEN p_size % 5 = 0 THEN NULL ELSE round(p_retailprice, 2) END AS previous, CAST(p_size * 1000 AS BIGINT) AS volume, CAST(p_size * 10 AS BIGINT) AS open_interest,
       CAST(p_size * 30 AS BIGINT) AS total, CAST(p_size * 10 AS BIGINT) AS calls, CAST(p_size * 20 AS BIGINT) AS puts
FROM part""",
)
def price_pages(spark, sf_dir):
    """Parts written as a page with a price table and a line of totals, and read back by position."""
    td = lambda c: F.concat(F.lit("<td class=x>"), c, F.lit("</td>"))
    price, n = dutch(F.col("p_retailprice")), F.col("p_size")
    isin = F.concat(F.lit("NL"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"))
    cells = [F.concat(F.lit("<a href='#'> "), "p_name", F.lit(" </a>")), isin, price, F.when(n % 5 == 0, "n.v.t.").otherwise(price), *[F.lit("-")] * 6, dutch(n * 1000, 0), dutch(n * 10, 0), F.lit("17:35")]
    totals = F.concat(F.lit("<p>Totaal <b>"), dutch(n * 30, 0), F.lit("</b> ("), dutch(n * 10, 0), F.lit(" Calls, "), dutch(n * 20, 0), F.lit(" Puts)</p>"))
    page = F.concat(totals, F.lit("<table><tr><th>Naam</th></tr><tr>"), *[td(c) for c in cells], F.lit("</tr></table>"))
    parts = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), "p_partkey")
    pages = parts.select("p_partkey", page.alias("html"))
    rows = io.price_table_from_pages(io.overview_from_pages(pages.withColumn("page", F.col("html")), "page"))
    return rows.select("p_partkey", "name", "isin", "last", "previous", "volume", "open_interest", "total", "calls", "puts")


@register(
    "chain_pages",
    """
WITH s AS (SELECT DISTINCT CAST(p_size AS DOUBLE) / 4 + 20 AS k, p_partkey FROM part),
f AS (SELECT p_partkey, round_even(k * 2, 0) / 2 AS strike FROM s)
SELECT p_partkey, option_type, DATE '2025-12-19' AS expiry_date, 'AH' AS symbol, strike, CASE option_type WHEN 'Call' THEN 1.25 WHEN 'Put' THEN NULL END AS bid, 2.5 AS ask FROM f, (VALUES ('Call'), ('Put')) o(option_type)""".replace("1.25", "1.25::DOUBLE").replace("2.5 AS", "2.5::DOUBLE AS"),
)
def chain_pages(spark, sf_dir):
    """Parts written as sections of an option-chain page, and read back."""
    strike = dutch(F.col("p_size") / 4 + 20)
    row = F.concat(F.lit("<section><h2>December 2025 (AEX / AH)</h2><table><tr><td>1,25</td><td>2,50</td><td>"), strike, F.lit("</td><td>n.v.t.</td><td>2,50</td></tr></table></section>"))
    parts = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    return io.chain_from_pages(parts.select("p_partkey", F.concat(F.lit("<main>"), row, F.lit("</main>")).alias("html")))


@register(
    "parsed_texts",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, CAST(o_custkey AS DOUBLE) / 4 AS pct, date_trunc('month', o_orderdate)::DATE + CAST((19 - dayofweek(date_trunc('month', o_orderdate))) % 7 + 14 AS INTEGER) AS expiry, 'A' || o_custkey % 10 AS symbol,
       CASE o_orderkey % 4 WHEN 0 THEN 'NL' WHEN 1 THEN 'UK' WHEN 2 THEN 'DE' ELSE 'US' END AS market, 'Q' || CAST((month(o_orderdate) - 1) // 3 + 1 AS VARCHAR) AS fiscal_quarter,
       round(CASE WHEN o_custkey <= 10 THEN 1 WHEN o_custkey <= 50 THEN 1 + (o_custkey - 10) / 40.0 WHEN o_custkey <= 100 THEN 2 + (o_custkey - 50) / 50.0 * 2 ELSE 4 END + 3e-9, 6) AS on_curve
FROM orders""",
)
def parsed_texts(spark, sf_dir):
    """Dates in four notations, percentages, expiry headers and tickers out of orders, written and parsed."""
    o = table(spark, sf_dir, "orders")
    d, n, c = F.to_date("o_orderdate"), F.col("o_orderkey"), F.col("o_custkey")
    date = F.when(n % 4 == 0, F.date_format(d, "dd-MM-yyyy")).when(n % 4 == 1, F.date_format(d, "dd/MM/yyyy")).when(n % 4 == 2, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "d MMM yyyy"))
    header = F.concat(F.date_format(d, "MMMM yyyy"), F.lit(" (AEX / A"), (c % 10).cast("string"), F.lit(")"))
    ticker = F.concat(F.lit("T"), F.when(n % 4 == 0, ".AS").when(n % 4 == 1, ".L").when(n % 4 == 2, ".DE").otherwise(""))
    e = parse_expiry(header)
    return o.select(
        "o_orderkey", parse_date(F.concat(F.lit(" "), date)).alias("parsed"), parse_percent(F.concat(dutch(c / 4), F.lit(" %"))).alias("pct"), e["expiry_date"].alias("expiry"), e["symbol"].alias("symbol"), market_of(ticker).alias("market"), fiscal_quarter(F.month(d)).alias("fiscal_quarter"),
        F.round(interpolate(c.cast("double"), [(10.0, 1.0), (50.0, 2.0), (100.0, 4.0)]) + 3e-9, 6).alias("on_curve"),
    )


# Rows that come again


@register(
    "merged_orders",
    """
WITH old AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 3 < 2), new AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 3 > 0),
a AS (SELECT * FROM (SELECT *, 0 AS f FROM old UNION ALL SELECT *, 1 FROM new) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, f DESC, o_orderkey DESC) = 1),
b AS (SELECT o_custkey, count(*) AS n FROM (SELECT o_custkey FROM old UNION ALL SELECT DISTINCT o_custkey FROM new WHERE o_custkey NOT IN (SELECT o_custkey FROM old)) GROUP BY 1),
c AS (SELECT o_custkey, count(*) AS n FROM (SELECT o_custkey FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new) UNION ALL SELECT o_custkey FROM new) GROUP BY 1)
SELECT a.o_custkey, CAST(a.o_orderdate AS DATE) AS newest, b.n AS after_insert, c.n AS after_replace FROM a JOIN b USING (o_custkey) JOIN c USING (o_custkey)""",
)
def merged_orders(spark, sf_dir):
    """Orders of customers from two overlapping deliveries: upserted, inserted where absent, and replaced by customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    old, new = o.where("o_orderkey % 3 < 2"), o.where("o_orderkey % 3 > 0")
    key = ["o_custkey"]
    a = upsert(old, new, key, "o_orderdate").select("o_custkey", F.to_date("o_orderdate").alias("newest"))
    b = insert_absent(old, new, key).groupBy(*key).agg(F.count("*").alias("after_insert"))
    c = replace_range(old, new, key).groupBy(*key).agg(F.count("*").alias("after_replace"))
    return a.join(b, key).join(c, key)


@register(
    "filled_trade_dates",
    """
WITH s AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS scraped, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS trade_date FROM orders),
k AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS scraped, max(CAST(o_orderdate AS DATE) - 1) AS d FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT s.o_orderkey, s.scraped, coalesce(trade_date, d, CASE dayofweek(s.scraped) WHEN 6 THEN s.scraped - 1 WHEN 0 THEN s.scraped - 2 ELSE s.scraped END) AS trade_date FROM s LEFT JOIN k USING (o_custkey, scraped)""",
)
def filled_trade_dates(spark, sf_dir):
    """Missing trade dates come from the overview scraped the same day, else from the day itself, weekends going to Friday."""
    o = table(spark, sf_dir, "orders").withColumn("scraped", F.to_date("o_orderdate"))
    rows = o.select("o_orderkey", "o_custkey", "scraped", F.when(F.col("o_orderkey") % 3 == 0, F.col("scraped")).alias("trade_date"))
    overview = o.where("o_orderstatus = 'F'").select("o_custkey", "scraped", F.date_sub("scraped", 1).alias("trade_date"))
    back = F.when(dow0(F.col("scraped")) == 6, F.date_sub("scraped", 1)).when(dow0(F.col("scraped")) == 0, F.date_sub("scraped", 2)).otherwise(F.col("scraped"))
    return filled_from(rows, overview, ["o_custkey", "scraped"], "trade_date", back).select("o_orderkey", "scraped", "trade_date")


# Daily summaries


def partial_states(chain: DataFrame) -> DataFrame:
    """Counts and sums of a delivery per day, expiry and type, small enough to keep and add up later."""
    return chain.groupBy("trade_date", "expiry_date", "option_type").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"), F.sum("open_interest").alias("open_interest"), F.sum("implied_volatility").alias("iv_sum"), F.count("implied_volatility").alias("iv_n"), F.max("last_price").alias("top_price"))


def merged_states(states: DataFrame) -> DataFrame:
    keys = ["trade_date", "expiry_date", "option_type"]
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "volume", "open_interest", "iv_sum", "iv_n")], F.max("top_price").alias("top_price")).withColumn("mean_iv", safe_div(F.col("iv_sum"), F.col("iv_n")))


DAILY = dict.fromkeys(["trade_date", "expiry_date", "option_type", "n", "volume", "open_interest"]) | {"mean_iv": 6, "top_price": 4}


@register(
    "daily_by_expiry",
    f"WITH {CHAIN}, d AS (SELECT trade_date, expiry_date, option_type, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(open_interest) AS BIGINT) AS open_interest, avg(implied_volatility) AS mean_iv, max(last_price) AS top_price FROM option_chain GROUP BY 1, 2, 3) SELECT {sql_rounded(DAILY)} FROM d",
)
def daily_by_expiry(spark, sf_dir):
    """The summary per day, expiry and type out of the states of several deliveries."""
    chain = chain_of(spark, sf_dir)
    first, second = (partial_states(chain.where(F.col("strike") % 2 == i)) for i in (0, 1))
    return select_rounded(merged_states(first.unionByName(second)), DAILY)


FIRST_LINES = 4  # lines up to this one come with the first delivery


@register(
    "surrogate_keys",
    f"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) WHERE l_linenumber <= {FIRST_LINES}),
b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) + (SELECT max(line_id) FROM a) AS line_id FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) WHERE l_linenumber > {FIRST_LINES})
SELECT * FROM a UNION ALL SELECT * FROM b""",
)
def surrogate_keys(spark, sf_dir):
    """Dense ids of two deliveries, the second one's following the first one's highest."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select(*key).distinct()
    first = with_dense_ids(lines.where(F.col("l_linenumber") <= FIRST_LINES), key, "line_id")
    return continue_ids(first, lines.where(F.col("l_linenumber") > FIRST_LINES), key, "line_id")


SKETCHED = {"sums": ["l_quantity"], "distinct": ["l_partkey"], "ranked": ["l_extendedprice"]}
DELIVERIES, DISTINCT_ERROR, RANK_ERROR = 4, 0.08, 0.03  # five times the sketches' usual error


@register(
    "delivery_sketches",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, count(DISTINCT l_partkey) AS parts, true AS distinct_in_bound, true AS median_in_bound
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def delivery_sketches(spark, sf_dir):
    """States of four deliveries, merged two by two and then together: counts and sums, and whether the distinct count and the
    median of the merged sketches are as near to the exact ones as they have to be."""
    keys = ["l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, "l_orderkey", "l_partkey", "l_extendedprice", F.col("l_quantity").cast("long").alias("l_quantity"))
    parts = [sketches.states(lines.where(F.pmod("l_orderkey", F.lit(DELIVERIES)) == i), keys, **SKETCHED) for i in range(DELIVERIES)]
    pairs = [sketches.merged(a.unionByName(b), keys, **SKETCHED) for a, b in zip(parts[::2], parts[1::2])]
    found = sketches.figures(sketches.merged(pairs[0].unionByName(pairs[1]), keys, **SKETCHED), SKETCHED["distinct"], SKETCHED["ranked"])
    below = F.avg((F.col("l_extendedprice") < F.col("p50_l_extendedprice")).cast("double"))
    exact = lines.join(found.select(*keys, "p50_l_extendedprice"), keys).groupBy(*keys).agg(F.count_distinct("l_partkey").alias("parts"), below.alias("share_below"))  # a row a key is found: broadcast while it is small
    near = F.abs(F.col("distinct_l_partkey") - F.col("parts")) <= DISTINCT_ERROR * F.col("parts")
    return found.join(exact, keys).select(*keys, "n", F.col("l_quantity").alias("quantity"), "parts", near.alias("distinct_in_bound"), (F.abs(F.col("share_below") - 0.5) <= RANK_ERROR).alias("median_in_bound"))


MART = dict.fromkeys(["ticker", "trade_date", "expiry_date", "call_oi", "put_oi", "n_strikes"]) | {"net_delta": 4, "net_gamma": 6, "net_vega": 4, "put_call_oi": 6, "mean_iv": 6}


@register(
    "expiry_greeks",
    f"""
WITH {CHAIN},
g AS (SELECT ticker, trade_date, expiry_date, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Call'), 0) AS BIGINT) AS call_oi, CAST(coalesce(sum(open_interest) FILTER (option_type = 'Put'), 0) AS BIGINT) AS put_oi, count(DISTINCT strike) AS n_strikes, sum(delta * open_interest) AS net_delta,
        sum(gamma * open_interest * CASE option_type WHEN 'Call' THEN 1 ELSE -1 END) AS net_gamma, sum(vega * open_interest) AS net_vega, avg(implied_volatility) AS mean_iv FROM option_chain GROUP BY 1, 2, 3),
m AS (SELECT *, put_oi / nullif(call_oi, 0) AS put_call_oi FROM g)
SELECT {sql_rounded(MART)} FROM m""",
)
def expiry_greeks(spark, sf_dir):
    """Open interest and Greeks weighted by it, per ticker, day and expiry."""
    call, oi = F.col("option_type") == "Call", F.col("open_interest")
    out = chain_of(spark, sf_dir).groupBy("ticker", "trade_date", "expiry_date").agg(
        F.sum(F.when(call, oi).otherwise(0)).alias("call_oi"), F.sum(F.when(~call, oi).otherwise(0)).alias("put_oi"), F.count_distinct("strike").alias("n_strikes"), F.sum(F.col("delta") * oi).alias("net_delta"),
        F.sum(F.col("gamma") * oi * F.when(call, 1).otherwise(-1)).alias("net_gamma"), F.sum(F.col("vega") * oi).alias("net_vega"), F.avg("implied_volatility").alias("mean_iv"),
    )
    return select_rounded(out.withColumn("put_call_oi", safe_div(F.col("put_oi"), F.col("call_oi"))), MART)
