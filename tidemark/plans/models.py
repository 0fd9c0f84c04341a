"""Splits, reports and models over the labelled events: fixed dates with an embargo and expanding folds, confusion and
high-confidence figures, the recommended threshold, isotonic calibration, baselines and ablation, and a bundle for production."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_div
from tidemark.plans import validation
from tidemark.plans.events import EVENT_CTE, all_events, hourly, labelled, window_features
from tidemark.plans.gold_chain import select_rounded, sql_rounded
from tidemark.plans.registry import ORACLES, QUERIES, register
from tidemark.plans.validation import HOURLY, MODEL_FEATURES, SCORED_CTE, scored_labels
from tidemark.session import stored

# Last day of training and of validation, the gap after each in hours, first day and number of days of a fold.
TRAIN_TO, VALID_TO, EMBARGO, FOLD_FROM, FOLD_DAYS = "2024-01-18", "2024-01-24", 40, "2024-01-10", 5
GOOD = 0.65  # accuracy from which the widest coverage is recommended


def split_of(at: Column) -> Column:
    return F.when(F.to_date(at) <= F.lit(TRAIN_TO).cast("date"), "train").when(F.to_date(at) <= F.lit(VALID_TO).cast("date"), "validation").otherwise("test")


def embargoed(at: Column, hours: int = EMBARGO) -> Column:
    """Within so many hours after the end of the split before: its labels may overlap that split."""
    after = lambda day: (at >= F.date_add(F.lit(day).cast("date"), 1).cast("timestamp")) & (at < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp") + F.expr(f"INTERVAL {hours} HOUR"))
    return after(TRAIN_TO) | after(VALID_TO)


@register(
    "event_splits",
    f"""
WITH e AS ({ORACLES["consolidation_events"]})
SELECT ticker, t_end, CASE WHEN CAST(t_end AS DATE) <= DATE '{TRAIN_TO}' THEN 'train' WHEN CAST(t_end AS DATE) <= DATE '{VALID_TO}' THEN 'validation' ELSE 'test' END AS split,
       (t_end >= DATE '{TRAIN_TO}' + INTERVAL 1 DAY AND t_end < DATE '{TRAIN_TO}' + INTERVAL 1 DAY + INTERVAL {EMBARGO} HOUR) OR (t_end >= DATE '{VALID_TO}' + INTERVAL 1 DAY AND t_end < DATE '{VALID_TO}' + INTERVAL 1 DAY + INTERVAL {EMBARGO} HOUR) AS embargoed,
       CASE WHEN CAST(t_end AS DATE) >= DATE '{FOLD_FROM}' THEN (CAST(t_end AS DATE) - DATE '{FOLD_FROM}') // {FOLD_DAYS} END AS tested_in_fold
FROM e""",
)
def event_splits(spark, sf_dir):
    """Split, embargo and the expanding fold that an event is tested in (it trains all later ones; those before the first only
    train)."""
    at = F.col("t_end").cast("timestamp")
    day = F.datediff(F.to_date(at), F.lit(FOLD_FROM).cast("date"))
    return QUERIES["consolidation_events"](spark, sf_dir).select("ticker", "t_end", split_of(at).alias("split"), embargoed(at).alias("embargoed"), F.when(day >= 0, F.floor(day / FOLD_DAYS)).cast("long").alias("tested_in_fold"))


BALANCE = {"label": None, "acc_dist": None, "n": None, "share_pct": 4}


@register("class_balance", f"WITH e AS ({ORACLES['consolidation_events']}), b AS (SELECT label, acc_dist, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct FROM e GROUP BY 1, 2) SELECT {sql_rounded(BALANCE)} FROM b")
def class_balance(spark, sf_dir):
    counts = QUERIES["consolidation_events"](spark, sf_dir).groupBy("label", "acc_dist").agg(F.count("*").alias("n"))
    return select_rounded(counts.withColumn("share_pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())), BALANCE)  # a row a class


REPORT = {"ticker": None, "tp": None, "fp": None, "fn": None, "tn": None, "f1": 6, "balanced_accuracy": 6, "n_sure": None, "accuracy_sure": 6}


def report(scored: DataFrame, key: str = "ticker", sure: float = 0.75) -> DataFrame:
    """Confusion counts, F1, balanced accuracy, and accuracy where the probability or its complement is at least `sure`."""
    yes, y = F.col("p_up") >= 0.5, F.col("y") == 1
    n = lambda cond: F.count(F.when(cond, 1))
    is_sure = F.greatest(F.col("p_up"), 1 - F.col("p_up")) >= sure
    out = scored.groupBy(key).agg(n(yes & y).alias("tp"), n(yes & ~y).alias("fp"), n(~yes & y).alias("fn"), n(~yes & ~y).alias("tn"), n(is_sure).alias("n_sure"), n(is_sure & (yes == y)).alias("right_sure"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return out.withColumns({"f1": safe_div(2 * tp, 2 * tp + fp + fn), "balanced_accuracy": (safe_div(tp, tp + fn) + safe_div(tn, tn + fp)) / 2, "accuracy_sure": safe_div(F.col("right_sure"), F.col("n_sure"))})


@register(
    "classification_report",
    f"""
WITH {HOURLY},{SCORED_CTE},
k AS (SELECT ticker, count(*) FILTER (p_up >= 0.5 AND y = 1) AS tp, count(*) FILTER (p_up >= 0.5 AND y = 0) AS fp, count(*) FILTER (p_up < 0.5 AND y = 1) AS fn, count(*) FILTER (p_up < 0.5 AND y = 0) AS tn,
        count(*) FILTER (greatest(p_up, 1 - p_up) >= 0.75) AS n_sure, count(*) FILTER (greatest(p_up, 1 - p_up) >= 0.75 AND (p_up >= 0.5) = (y = 1)) AS right_sure FROM sc GROUP BY ticker),
m AS (SELECT *, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1, (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 AS balanced_accuracy, right_sure / nullif(n_sure, 0) AS accuracy_sure FROM k)
SELECT {sql_rounded(REPORT)} FROM m""",
)
def classification_report(spark, sf_dir):
    return select_rounded(report(scored_labels(spark, sf_dir)), REPORT)


@register(
    "recommended_threshold",
    f"""
WITH s AS ({ORACLES["threshold_sweep"]}),
o AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN accuracy >= {GOOD} THEN 0 ELSE 1 END, CASE WHEN accuracy >= {GOOD} THEN coverage END DESC NULLS LAST, expected_value DESC NULLS LAST, threshold) AS place FROM s)
SELECT threshold, coverage, accuracy, expected_value, coalesce(accuracy >= {GOOD}, false) AS by_accuracy FROM o WHERE place = 1""",
)
def recommended_threshold(spark, sf_dir):
    """The threshold of the widest coverage among those accurate enough, else the one of the highest expected value."""
    good = F.coalesce(F.col("accuracy") >= GOOD, F.lit(False))
    sweep = QUERIES["threshold_sweep"](spark, sf_dir).withColumn("by_accuracy", good)  # nine rows
    best = sweep.orderBy(F.desc("by_accuracy"), F.when(F.col("by_accuracy"), F.col("coverage")).desc_nulls_last(), F.col("expected_value").desc_nulls_last(), "threshold").limit(1)
    return best.select("threshold", "coverage", "accuracy", "expected_value", "by_accuracy")


# Models


def calibrated(scored: DataFrame) -> DataFrame:
    """Adds the isotonic fit of y by p_up, as `calibrated`."""
    from pyspark.ml.regression import IsotonicRegression

    rows = scored.withColumn("y", F.col("y").cast("double"))
    fitted = IsotonicRegression(featuresCol="p_up", labelCol="y", predictionCol="calibrated").fit(rows)
    return fitted.transform(rows)


CALIBRATED = {"p_up": 9, "n": None, "share_up": 6, "calibrated": 6}


@register(
    "isotonic_calibration",
    f"""
WITH {HOURLY},{SCORED_CTE},
g AS (SELECT p_up, count(*) AS n, sum(y) AS up FROM sc GROUP BY p_up),
c AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY p_up) AS i, sum(n) OVER (ORDER BY p_up) AS cn, sum(up) OVER (ORDER BY p_up) AS cu FROM g),
m AS (SELECT a.i AS a, b.i AS b, (b.cu - a.cu + a.up) / (b.cn - a.cn + a.n) AS mean FROM c a JOIN c b ON b.i >= a.i),
l AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS least FROM m),
f AS (SELECT b AS i, max(least) OVER (PARTITION BY b ORDER BY a ROWS UNBOUNDED PRECEDING) AS best, a FROM l),
z AS (SELECT c.p_up, c.n, c.up / c.n AS share_up, best AS calibrated FROM f JOIN c ON c.i = f.i WHERE f.a = f.i)
SELECT {sql_rounded(CALIBRATED)} FROM z""",
)
def isotonic_calibration(spark, sf_dir):
    """The fitted step at each probability; the SQL says the same as the largest of the least means of runs around it."""
    rows = calibrated(scored_labels(spark, sf_dir))
    out = rows.groupBy("p_up").agg(F.count("*").alias("n"), F.avg("y").alias("share_up"), F.max("calibrated").alias("calibrated"))
    return select_rounded(out, CALIBRATED)


def training_rows(spark, sf_dir) -> DataFrame:
    ev, base = all_events(hourly(spark, sf_dir))
    rows = labelled(ev, base).where("label <> 'NO_RESOLVE'").join(window_features(ev, base), ["ticker", "run"])
    at = F.col("t_end").cast("timestamp")
    return rows.withColumns({"y": (F.col("label") == "UP_RESOLVE").cast("double"), "split": split_of(at), "embargoed": embargoed(at)}).na.fill(0.0, MODEL_FEATURES)


def fitted(train: DataFrame, features: list[str], kind: str = "logistic", rounds: int = 200):
    """A pipeline fitted on train: scaled logistic regression or boosted trees of depth three."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    stages = [VectorAssembler(inputCols=features, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="x", withMean=True)]
    model = GBTClassifier(featuresCol="x", labelCol="y", maxDepth=3, maxIter=rounds, seed=1) if kind == "boosted" else LogisticRegression(featuresCol="x", labelCol="y", regParam=0.01, maxIter=50)
    return Pipeline(stages=[*stages, model]).fit(train)


@register("model_ablation")
def model_ablation(spark, sf_dir):
    """Accuracy and Brier score outside the training split: the share of the training labels alone, all features, and all but
    each one. No oracle: the fits are not reproducible in SQL."""
    from pyspark.ml.functions import vector_to_array

    rows = training_rows(spark, sf_dir).where("not embargoed").select("ticker", "t_end", "split", "y", *MODEL_FEATURES).persist()
    train = rows.where("split = 'train'")
    known = train.agg(F.coalesce(F.avg("y"), F.lit(0.5)).alias("p"), F.count_distinct("y").alias("classes")).first()
    parts = [rows.where("split <> 'train'").withColumns({"model": F.lit("share"), "p_up": F.lit(float(known["p"]))})]
    if known["classes"] == 2:
        for name, features in ({"all": MODEL_FEATURES} | {f"without {f}": [x for x in MODEL_FEATURES if x != f] for f in MODEL_FEATURES}).items():
            scored = fitted(train, features).transform(rows.where("split <> 'train'"))
            parts.append(scored.withColumns({"model": F.lit(name), "p_up": vector_to_array("probability")[1]}))
    every = parts[0].select("model", "y", "p_up")
    for p in parts[1:]:
        every = every.unionByName(p.select("model", "y", "p_up"))
    return every.groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg(((F.col("p_up") >= 0.5) == (F.col("y") == 1)).cast("double")), 6).alias("accuracy"), F.round(F.avg(F.pow(F.col("p_up") - F.col("y"), 2)), 6).alias("brier"))


# Expanding folds: fold k is tested on FOLD_DAYS days, less the embargo at their start, and trained on all events before them


def fold_of(at: Column) -> Column:
    """The fold whose days hold the event, -1 before the first: it trains every later fold."""
    return F.greatest(F.floor(F.datediff(F.to_date(at), F.lit(FOLD_FROM).cast("date")) / FOLD_DAYS), F.lit(-1)).cast("long")


def foldable(spark, sf_dir) -> DataFrame:
    """Training rows with their fold and whether it tests them; those in its embargo train later folds alone."""
    at = F.col("t_end").cast("timestamp")
    start = F.date_add(F.lit(FOLD_FROM).cast("date"), (F.col("fold") * FOLD_DAYS).cast("int")).cast("timestamp")
    rows = training_rows(spark, sf_dir).withColumn("fold", fold_of(at))
    return rows.withColumn("tested", (F.col("fold") >= 0) & (at >= start + F.expr(f"INTERVAL {EMBARGO} HOUR"))).select("ticker", "t_end", "fold", "tested", "y", *MODEL_FEATURES)


def fold_shares(rows: DataFrame) -> DataFrame:
    """Per fold that tests any: how many train it and the share of 1 among them (one half where none does), by running sums
    over one row a fold. Folds in which no event falls are not listed."""
    per = rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("up"), F.count(F.when(F.col("tested"), 1)).alias("n_test"))
    before = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)  # a row a fold
    out = per.withColumns({"n_train": F.coalesce(F.sum("n").over(before), F.lit(0)), "up_train": F.sum("up").over(before)})
    return out.where("fold >= 0 and n_test > 0").select("fold", "n_train", "n_test", "up_train", F.coalesce(safe_div(F.col("up_train"), F.col("n_train")), F.lit(0.5)).alias("share"))


def fold_scores(rows: DataFrame, kinds: tuple[str, ...] = ("logistic", "boosted"), rounds: int = 200, parallel: int = 4) -> DataFrame:
    """Scores out of fold (fold, model, n_train, y, p_up) by the share of the training labels and by each kind of model, fitted
    anew on every fold's past; a fold whose past holds one label alone is scored by its share. rows should be stored: each fit reads
    them. The fits of so many (fold, model) pairs run at once, each of them spread over the cluster."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.functions import vector_to_array

    known = {r.fold: r for r in fold_shares(rows).collect()}  # a row a fold
    tested = rows.where("tested")
    if not known:
        return tested.select("fold", F.lit("share").alias("model"), F.lit(0).cast("long").alias("n_train"), "y", F.lit(0.5).alias("p_up"))

    def one(pair):
        k, kind = pair
        r = known[k]
        test = tested.where(F.col("fold") == k)
        if kind == "share" or not 0 < r.up_train < r.n_train:
            scored = test.withColumn("p_up", F.lit(float(r.share)))
        else:
            scored = fitted(rows.where(F.col("fold") < k), MODEL_FEATURES, kind, rounds).transform(test).withColumn("p_up", vector_to_array("probability")[1])
        return scored.select("fold", F.lit(kind).alias("model"), F.lit(r.n_train).cast("long").alias("n_train"), "y", "p_up")

    with ThreadPoolExecutor(parallel) as pool:
        parts = list(pool.map(one, [(k, kind) for k in sorted(known) for kind in ("share", *kinds)]))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def fold_figures(scores: DataFrame) -> DataFrame:
    """Per model and fold, and over all folds pooled (fold null): training and tested events, accuracy, Brier score, and the area
    under the ROC curve by ranks, ties sharing their mean rank."""
    both = scores.withColumn("part", F.explode(F.array(F.col("fold"), F.lit(None).cast("long"))))
    n = Window.partitionBy("model", "part")
    ranked = both.groupBy("model", "part", "p_up").agg(F.count("*").alias("n"), F.sum("y").alias("up"), F.max("n_train").alias("n_train"))  # equal scores first become one row
    ranked = ranked.withColumn("below", F.sum("n").over(n.orderBy("p_up").rowsBetween(Window.unboundedPreceding, -1)))
    mean_rank = F.coalesce("below", F.lit(0)) + (F.col("n") + 1) / 2
    down = F.col("n") - F.col("up")
    out = ranked.groupBy("model", F.col("part").alias("fold")).agg(
        F.max("n_train").alias("n_train"), F.sum("n").alias("n_test"), F.sum("up").alias("ups"), F.sum(down).alias("downs"), F.sum(F.when(F.col("p_up") >= 0.5, F.col("up")).otherwise(down)).alias("right"),
        F.sum(F.col("up") * F.pow(F.col("p_up") - 1, 2) + down * F.pow("p_up", 2)).alias("squares"), F.sum(F.col("up") * mean_rank).alias("ranks"),
    )
    return out.select("model", "fold", "n_train", "n_test", (F.col("right") / F.col("n_test")).alias("accuracy"), (F.col("squares") / F.col("n_test")).alias("brier"), safe_div(F.col("ranks") - F.col("ups") * (F.col("ups") + 1) / 2, F.col("ups") * F.col("downs")).alias("auc"))


FOLDS = {"model": None, "fold": None, "n_train": None, "n_test": None, "accuracy": 6, "brier": 6, "auc": 6}


@register("fold_models")
def fold_models(spark, sf_dir):
    """The share of the training labels, scaled logistic regression and boosted trees over the expanding folds. No oracle: the
    fits are not reproducible in SQL; fold_baseline is the share's part with one."""
    scores = fold_scores(stored(foldable(spark, sf_dir)), rounds=validation.BOOSTING_ROUNDS)
    return select_rounded(fold_figures(scores), FOLDS)


@register(
    "fold_baseline",
    f"""
WITH {HOURLY},{EVENT_CTE},
f AS (SELECT greatest(CAST(floor((CAST(t_end AS DATE) - DATE '{FOLD_FROM}') / {FOLD_DAYS}) AS BIGINT), -1) AS fold, t_end, CASE WHEN label = 'UP_RESOLVE' THEN 1 ELSE 0 END AS y FROM event_rows WHERE label <> 'NO_RESOLVE'),
t AS (SELECT *, fold >= 0 AND t_end >= CAST(DATE '{FOLD_FROM}' + CAST(fold * {FOLD_DAYS} AS INTEGER) AS TIMESTAMP) + INTERVAL {EMBARGO} HOUR AS tested FROM f),
s AS (SELECT k.fold, (SELECT count(*) FROM t p WHERE p.fold < k.fold) AS n_train, coalesce((SELECT avg(y) FROM t p WHERE p.fold < k.fold), 0.5) AS p_up FROM (SELECT DISTINCT fold FROM t WHERE tested) k),
o AS (SELECT t.fold, n_train, p_up, y FROM t JOIN s USING (fold) WHERE tested),
b AS (SELECT * FROM o UNION ALL SELECT NULL, n_train, p_up, y FROM o),
r AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY p_up) + (count(*) OVER (PARTITION BY fold, p_up) - 1) / 2.0 AS rk FROM b),
g AS (SELECT 'share' AS model, fold, max(n_train) AS n_train, count(*) AS n_test, avg(if((p_up >= 0.5) = (y = 1), 1, 0)) AS accuracy, avg(power(p_up - y, 2)) AS brier,
        (sum(rk) FILTER (y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2) / nullif(CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)), 0) AS auc FROM r GROUP BY fold)
SELECT {sql_rounded(FOLDS)} FROM g""",
)
def fold_baseline(spark, sf_dir):
    """What a model that knows only the share of the labels before a fold scores on it."""
    return select_rounded(fold_figures(fold_scores(stored(foldable(spark, sf_dir)), kinds=())), FOLDS)


def write_bundle(spark, path: str, features: list[str], config: dict, metrics: dict, model=None) -> None:
    """What production needs: the ordered features, the decision rule and the figures as JSON, the model beside them."""
    text = json.dumps({"features": features, "config": config, "metrics": metrics}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/bundle")
    if model is not None:
        model.write().overwrite().save(f"{path}/model")


def read_bundle(spark, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/bundle").first()[0])
