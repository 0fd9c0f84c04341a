"""Model and strategy validation: threshold sweep, ranking metrics, reliability bins, walk-forward windows, slippage, top
performers, and a trained classifier beside the fixed rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_div
from tidemark.plans.events import ATR_STOP, ATR_TARGET, EVENT_CTE, FEE, HOLD, SIZE, TRADE_CTE, all_events, all_trades, hourly, labelled, score, trades, window_features
from tidemark.plans.gold_chain import select_rounded, sql_rounded
from tidemark.plans.registry import register
from tidemark.session import stored
from tidemark.sources import adapters

HOURLY = adapters.oracle("bars_hourly")
SCORED_CTE = f"""{EVENT_CTE},
sc AS (SELECT e.ticker, e.t_end, round(1 / (1 + exp(-(-12 * r_pre + 400 * slope_end + 2 * (range_end - 0.2)))), 9) AS p_up, CASE WHEN label = 'UP_RESOLVE' THEN 1 ELSE 0 END AS y FROM event_rows e WHERE label <> 'NO_RESOLVE')"""


def scored_labels(spark, sf_dir) -> DataFrame:
    ev, base = all_events(hourly(spark, sf_dir))
    rows = score(labelled(ev, base)).where("label <> 'NO_RESOLVE'")
    return rows.select("ticker", "t_end", "p_up", (F.col("label") == "UP_RESOLVE").cast("int").alias("y"))


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Coverage and accuracy of acting only where the probability or its complement reaches each threshold. The grid is nine
    literals, so each row is spelled out nine times and aggregated at once."""
    sure = F.greatest(F.col("p_up"), 1 - F.col("p_up"))
    right = ((F.col("p_up") >= 0.5).cast("int") == F.col("y")).cast("int")
    grid = F.explode(F.array(*[F.lit(x / 100) for x in range(50, 95, 5)]))
    rows = scored.select(F.round(sure, 9).alias("sure"), right.alias("right"), grid.alias("threshold"))
    out = rows.groupBy("threshold").agg(F.count("*").alias("n"), F.count(F.when(F.col("sure") >= F.col("threshold"), 1)).alias("acted"), F.sum(F.when(F.col("sure") >= F.col("threshold"), F.col("right"))).alias("hits"))
    return out.withColumns({"coverage": F.col("acted") / F.col("n"), "accuracy": safe_div(F.col("hits"), F.col("acted")), "expected_value": safe_div(2 * F.col("hits") - F.col("acted"), F.col("acted"))})


SWEEP = {"threshold": 2, "n": None, "acted": None, "coverage": 6, "accuracy": 6, "expected_value": 6}


@register(
    "threshold_sweep",
    f"""
WITH {HOURLY},{SCORED_CTE},
g AS (SELECT unnest([0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90])::DOUBLE AS threshold),
s AS (SELECT threshold, count(*) AS n, count(*) FILTER (round(greatest(p_up, 1 - p_up), 9) >= threshold) AS acted, sum(CAST((p_up >= 0.5) = (y = 1) AS INTEGER)) FILTER (round(greatest(p_up, 1 - p_up), 9) >= threshold) AS hits FROM sc, g GROUP BY threshold),
r AS (SELECT *, acted / n AS coverage, hits / nullif(acted, 0) AS accuracy, (2 * hits - acted) / nullif(acted, 0) AS expected_value FROM s)
SELECT {sql_rounded(SWEEP)} FROM r""",
)
def threshold_sweep_query(spark, sf_dir):
    return select_rounded(threshold_sweep(scored_labels(spark, sf_dir)), SWEEP)


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, Brier score, precision, recall, and the area under the ROC curve by ranks (ties share their mean rank), per
    ticker."""
    w = Window.partitionBy("ticker")
    ties = Window.partitionBy("ticker", "p_up")
    rows = scored.withColumn("rank", F.rank().over(w.orderBy("p_up")) + (F.count("*").over(ties) - 1) / 2)
    y, yes = F.col("y"), F.col("p_up") >= 0.5
    pos, neg = F.sum("y"), F.sum(1 - y)
    out = rows.groupBy("ticker").agg(
        F.count("*").alias("n"), pos.alias("pos"), neg.alias("neg"), F.avg((yes.cast("int") == y).cast("double")).alias("accuracy"), F.avg(F.pow(F.col("p_up") - y, 2)).alias("brier"), F.sum(F.when(y == 1, F.col("rank"))).alias("ranks"),
        safe_div(F.sum(F.when(yes, y)), F.count(F.when(yes, 1))).alias("precision"), safe_div(F.sum(F.when(yes, y)), pos).alias("recall"),
    )
    return out.withColumn("auc", safe_div(F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2, F.col("pos") * F.col("neg")))


METRICS = {"ticker": None, "n": None, "accuracy": 6, "brier": 6, "precision": 6, "recall": 6, "auc": 6}


@register(
    "ranking_metrics",
    f"""
WITH {HOURLY},{SCORED_CTE},
k AS (SELECT *, rank() OVER (PARTITION BY ticker ORDER BY p_up) + (count(*) OVER (PARTITION BY ticker, p_up) - 1) / 2 AS rk FROM sc),
m AS (SELECT ticker, count(*) AS n, avg(CAST((p_up >= 0.5) = (y = 1) AS INTEGER)) AS accuracy, avg((p_up - y) ** 2) AS brier, sum(y) FILTER (p_up >= 0.5) / nullif(count(*) FILTER (p_up >= 0.5), 0) AS precision, coalesce(sum(y) FILTER (p_up >= 0.5) / nullif(sum(y), 0), NULL) AS recall,
        (sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * sum(1 - y), 0) AS auc FROM k GROUP BY ticker)
SELECT {sql_rounded(METRICS)} FROM m""",
)
def ranking_metrics_query(spark, sf_dir):
    return select_rounded(ranking_metrics(scored_labels(spark, sf_dir)), METRICS)


BINS = {"bin": None, "n": None, "mean_p": 6, "share_up": 6}


@register("reliability_bins", f"WITH {HOURLY},{SCORED_CTE}, b AS (SELECT CAST(least(floor(p_up * 10), 9) AS BIGINT) AS bin, count(*) AS n, avg(p_up) AS mean_p, avg(y) AS share_up FROM sc GROUP BY 1) SELECT {sql_rounded(BINS)} FROM b")
def reliability_bins(spark, sf_dir):
    out = scored_labels(spark, sf_dir).groupBy(F.least(F.floor(F.col("p_up") * 10), F.lit(9)).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.avg("p_up").alias("mean_p"), F.avg("y").alias("share_up"))
    return select_rounded(out, BINS)


def walk_forward(closed: DataFrame, months: int = 3) -> DataFrame:
    """Results by test window of so many months; a trade's window follows from its month, so nothing is joined by range."""
    month = F.year("t_end") * 12 + F.month("t_end") - 1
    done = closed.where("pnl_pct is not null").withColumn("window", F.floor(month / months).cast("long"))
    out = done.groupBy("window").agg(F.count("*").alias("n_trades"), F.avg((F.col("pnl_eur") > 0).cast("double")).alias("win_rate"), F.avg("pnl_pct").alias("mean_pct"), F.stddev_samp("pnl_pct").alias("std_pct"), F.sum("pnl_eur").alias("total_eur"))
    return out.withColumn("sharpe", safe_div(F.col("mean_pct"), F.col("std_pct")))


FORWARD = {"window": None, "n_trades": None, "win_rate": 6, "mean_pct": 4, "std_pct": 4, "total_eur": 2, "sharpe": 4}


@register(
    "walk_forward",
    f"""
WITH {HOURLY},{TRADE_CTE},
f AS (SELECT CAST(floor((year(t_end) * 12 + month(t_end) - 1) / 3) AS BIGINT) AS "window", count(*) AS n_trades, avg(if(pnl_eur > 0, 1, 0)) AS win_rate, avg(pnl_pct) AS mean_pct, CASE WHEN count(*) > 1 THEN stddev_samp(pnl_pct) END AS std_pct, sum(pnl_eur) AS total_eur
      FROM trade_rows WHERE pnl_pct IS NOT NULL GROUP BY 1),
s AS (SELECT *, mean_pct / nullif(std_pct, 0) AS sharpe FROM f)
SELECT {sql_rounded(FORWARD).replace("window, ", '"window", ', 1)} FROM s""",
)
def walk_forward_query(spark, sf_dir):
    return select_rounded(walk_forward(all_trades(spark, sf_dir)), FORWARD)


SLIPPAGE = {"slip_bps": 1, "n_trades": None, "mean_pct": 4, "total_eur": 2}
LEVELS = (0.0, 5.0, 10.0, 20.0)


@register(
    "slippage_curve",
    f"""
WITH {HOURLY},{TRADE_CTE.split("en AS (SELECT sd.*")[0].rstrip().rstrip(",")},
en AS (SELECT sd.*, slip_bps, b.open * (1 + d * slip_bps / 10000) AS entry FROM sd JOIN e3 b ON b.ticker = sd.ticker AND b.idx = sd.end_idx + 1, (SELECT unnest([0.0, 5.0, 10.0, 20.0])::DOUBLE AS slip_bps)),
th AS (SELECT en.ticker, en.end_idx, slip_bps, d, entry, atr_end, min(b.idx - en.end_idx) FILTER (CASE WHEN d > 0 THEN b.high >= entry + {ATR_TARGET} * atr_end ELSE b.low <= entry - {ATR_TARGET} * atr_end END) AS won,
         min(b.idx - en.end_idx) FILTER (CASE WHEN d > 0 THEN b.low <= entry - {ATR_STOP} * atr_end ELSE b.high >= entry + {ATR_STOP} * atr_end END) AS lost, count(*) AS seen, arg_max(b.close, b.idx) AS last_close
       FROM en JOIN e3 b ON b.ticker = en.ticker AND b.idx > en.end_idx AND b.idx <= en.end_idx + {HOLD} GROUP BY ALL),
tx AS (SELECT *, CASE WHEN won IS NOT NULL AND won <= coalesce(lost, 10000) THEN entry + d * {ATR_TARGET} * atr_end WHEN lost IS NOT NULL THEN entry - d * {ATR_STOP} * atr_end WHEN seen >= {HOLD} THEN last_close END * (1 - d * slip_bps / 10000) AS exit_price FROM th),
tp AS (SELECT slip_bps, d * (exit_price / entry - 1) * 100 AS pnl_pct FROM tx WHERE exit_price IS NOT NULL),
s AS (SELECT slip_bps, count(*) AS n_trades, avg(pnl_pct) AS mean_pct, sum({SIZE} * pnl_pct / 100 - {FEE}) AS total_eur FROM tp GROUP BY slip_bps)
SELECT {sql_rounded(SLIPPAGE)} FROM s""",
)
def slippage_curve(spark, sf_dir):
    """Totals at several basis points against entry and exit, out of one run of the events: each signal is spelled out once
    per level."""
    ev, base = all_events(hourly(spark, sf_dir))
    signals = score(ev).withColumn("slip_bps", F.explode(F.array(*map(F.lit, LEVELS))))
    done = trades(signals, base, slip_bps=F.col("slip_bps"), by=["slip_bps"]).where("pnl_pct is not null")
    return select_rounded(done.groupBy("slip_bps").agg(F.count("*").alias("n_trades"), F.avg("pnl_pct").alias("mean_pct"), F.sum("pnl_eur").alias("total_eur")), SLIPPAGE)


TOP = {"ticker": None, "total_eur": 2, "share_pct": 4, "profit_rank": None, "total_without_eur": 2}


@register(
    "top_performers",
    f"""
WITH {HOURLY},{TRADE_CTE},
t AS (SELECT ticker, sum(pnl_eur) AS total_eur FROM trade_rows WHERE pnl_pct IS NOT NULL GROUP BY ticker),
r AS (SELECT *, total_eur / nullif(sum(total_eur) OVER (), 0) * 100 AS share_pct, row_number() OVER (ORDER BY round(total_eur, 6) DESC, ticker) AS profit_rank, sum(total_eur) OVER () - total_eur AS total_without_eur FROM t)
SELECT {sql_rounded(TOP)} FROM r""",
)
def top_performers(spark, sf_dir):
    """Each ticker's part in the result and what is left without it; ranked over one row per ticker."""
    per = all_trades(spark, sf_dir).where("pnl_pct is not null").groupBy("ticker").agg(F.sum("pnl_eur").alias("total_eur"))
    w = Window.partitionBy()
    whole = F.sum("total_eur").over(w)
    out = per.withColumns({"share_pct": safe_div(F.col("total_eur"), whole) * 100, "profit_rank": F.row_number().over(w.orderBy(F.desc(F.round("total_eur", 6)), "ticker")).cast("long"), "total_without_eur": whole - F.col("total_eur")})
    return select_rounded(out, TOP)


MODEL_FEATURES = ["range_pct", "up_volume_share", "clv_mean", "pos_end", "upper_wick", "lower_wick", "net_return", "r_pre"]


BOOSTING_ROUNDS = 200


@register("trained_signals")
def trained_signals(spark, sf_dir):
    """Boosted trees fitted on the events up to the 70th percentile of time and scored on the later ones. No oracle: the fit is
    not reproducible in SQL."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    ev, base = all_events(hourly(spark, sf_dir))
    rows = labelled(ev, base).where("label <> 'NO_RESOLVE'").join(window_features(ev, base), ["ticker", "run"]).withColumn("y", (F.col("label") == "UP_RESOLVE").cast("double")).na.fill(0.0, MODEL_FEATURES)
    rows = stored(rows.withColumn("at", F.col("t_end").cast("timestamp").cast("long")))  # each of the rounds reads them
    cut = rows.select(F.percentile_approx("at", 0.7)).first()[0]
    if rows.where((F.col("at") <= cut)).select("y").distinct().count() < 2:
        return rows.where(F.col("at") > cut).select("ticker", "t_end", F.lit(0.5).alias("p_up"), "y")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=MODEL_FEATURES, outputCol="x"), GBTClassifier(featuresCol="x", labelCol="y", maxDepth=3, maxIter=BOOSTING_ROUNDS, seed=1)]).fit(rows.where(F.col("at") <= cut))
    return fitted.transform(rows.where(F.col("at") > cut)).select("ticker", "t_end", F.round(vector_to_array("probability")[1], 6).alias("p_up"), "y")


# Number texts written the Dutch way, parsed back


@register("parse_dutch_numbers", "SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY l_returnflag")
def parse_dutch_numbers(spark, sf_dir):
    from tidemark.functions.text import parse_number
    from tidemark.session import table

    written = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", parse_number(F.concat(F.lit("€ "), written)).alias("x"))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("x"), 2).alias("total"), F.sum(F.round(F.col("x") * 100).cast("long")).alias("cents"))


@register(
    "event_json_fields",
    """
WITH j AS (SELECT event_type, user_id, value, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, count(*) AS n, count(k) AS with_k, count(DISTINCT k) AS distinct_k, CAST(sum(k) AS BIGINT) AS sum_k, count(DISTINCT user_id) FILTER (k >= 50) AS users_of_high_k, round(sum(value) FILTER (k >= 50), 4) AS value_of_high_k, min(ts) AS first_ts FROM j GROUP BY event_type""",
)
def event_json_fields(spark, sf_dir):
    """Fields of the JSON text, read by a schema."""
    from tidemark.session import table

    rows = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k long")["k"])
    high = F.col("k") >= 50
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("k").alias("with_k"), F.count_distinct("k").alias("distinct_k"), F.sum("k").alias("sum_k"), F.count_distinct(F.when(high, F.col("user_id"))).alias("users_of_high_k"), F.round(F.sum(F.when(high, F.col("value"))), 4).alias("value_of_high_k"), F.min("ts").alias("first_ts")
    )
