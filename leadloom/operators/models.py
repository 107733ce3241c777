"""Learned models on Spark: anomaly forest, switch classifier, pairwise ranker, and their measures.

Training reads samples or runs in Spark ML; scoring runs over all rows. Results cannot equal
another library's numbers; inputs, ranges and directions are the same.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadloom.config import Models
from leadloom.functions.values import as_ts, tidy_round, whole_days
from leadloom.operators.forests import forest_explanations, forest_of
from leadloom.operators.switch import FEATURES
from leadloom.session import staged

ANOMALY_FEATURES = ("mean_qty", "cv_qty", "slope", "zero_frac", "recent_vs_baseline")


def _average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(points: np.ndarray, rng: np.random.Generator, depth: int, limit: int):
    """A random tree as nested lists: [feature, cut, left, right] or the leaf's expected path length."""
    low, high = (points.min(axis=0), points.max(axis=0)) if len(points) else (None, None)
    if depth >= limit or len(points) <= 1 or not (high > low).any():
        return depth + _average_path(len(points))
    feature = int(rng.choice(np.flatnonzero(high > low)))
    cut = float(rng.uniform(low[feature], high[feature]))
    left = points[:, feature] < cut
    return [feature, cut, _grow(points[left], rng, depth + 1, limit), _grow(points[~left], rng, depth + 1, limit)]


def _lengths(tree, points: np.ndarray) -> np.ndarray:
    if not isinstance(tree, list):
        return np.full(len(points), float(tree))
    out = np.empty(len(points))
    left = points[:, tree[0]] < tree[1]
    out[left], out[~left] = _lengths(tree[2], points[left]), _lengths(tree[3], points[~left])
    return out


def fit_anomaly_forest(features: DataFrame, trees: int = 100, sample: int = 256, cfg: Models = Models()) -> dict | None:
    """An isolation forest over the five series features as a plain dict: columns, means, deviations, trees, typical length.

    A tree grows on ``sample`` rows without repeats, out of a pool of the ``trees * sample`` rows whose keys hash lowest; the
    pool has a fixed bound, whatever the input, and goes to the tasks that grow the trees. None without rows.
    """
    cols = list(ANOMALY_FEATURES)
    known = features.select("rel_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    stats = known.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    mean, sd = [stats[f"m_{c}"] for c in cols], [stats[f"s_{c}"] for c in cols]
    pool = known.orderBy(F.xxhash64("rel_id", F.lit(cfg.seed)), "rel_id").limit(trees * sample).collect()
    if not pool:
        return None
    points = np.array([[r[c] for c in cols] for r in pool], float)
    spread = np.array([s or np.inf for s in sd])  # a constant feature is 0 everywhere
    spark, points = features.sparkSession, (points - mean) / spread
    shared = spark.sparkContext.broadcast(points)
    size, limit = min(sample, len(points)), math.ceil(math.log2(max(2, min(sample, len(points)))))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree in batch["id"].tolist():
                rng = np.random.default_rng([cfg.seed, tree])
                own = shared.value[np.sort(rng.choice(len(shared.value), size, replace=False))]
                yield pd.DataFrame({"tree": [tree], "body": [json.dumps(_grow(own, rng, 0, limit))]})

    grown = spark.range(trees).repartition(min(trees, 32)).mapInPandas(grow, "tree long, body string").collect()
    bodies = [json.loads(r["body"]) for r in sorted(grown, key=lambda r: r["tree"])]
    return {"columns": cols, "mean": mean, "deviation": sd, "trees": bodies, "typical": _average_path(max(2, size))}


def _raw_anomalies(model: dict, features: DataFrame) -> DataFrame:
    """(rel_id, raw): 2 to the minus mean path length over the typical one."""
    forest = features.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        own = forest.value
        spread = np.array([s or np.inf for s in own["deviation"]])
        for columns in batches:
            points = (np.column_stack([c.to_numpy(float) for c in columns]) - own["mean"]) / spread
            yield pd.Series(2.0 ** (-np.mean([_lengths(t, points) for t in own["trees"]], axis=0) / own["typical"]))

    return features.select("rel_id", score(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model["columns"]]).alias("raw"))


def with_range(model: dict, features: DataFrame) -> dict:
    """The model with the range of its raw scores over these rows, so that single rows can be scored alike later."""
    low, high = _raw_anomalies(model, features).agg(F.min("raw"), F.max("raw")).first()
    return model | {"range": [low, high]}


def anomaly_scores(model: dict, features: DataFrame) -> DataFrame:
    """Adds anomaly_score 0..1 (1 most anomalous) by a forest of ``fit_anomaly_forest``: raw scores stretched to 0..1 over the
    model's own range where it holds one, else over all these rows."""
    raw, floor = _raw_anomalies(model, features), F.lit(1e-9)
    if model.get("range"):
        low, high = (F.lit(float(v)) for v in model["range"])
        normal = raw.select("rel_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("raw") - low) / F.greatest(high - low, floor))).alias("anomaly_score"))
        return features.join(normal, "rel_id")
    scored = staged(raw, "anomalies").withColumn("_k", F.lit(1))  # read for the range and for the rows
    span = scored.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).withColumn("_k", F.lit(1))
    normal = scored.join(F.broadcast(span), "_k").select("rel_id", ((F.col("raw") - F.col("lo")) / F.greatest(
        F.col("hi") - F.col("lo"), floor)).alias("anomaly_score"))
    return features.join(normal, "rel_id")


def anomaly_forest(features: DataFrame, trees: int = 100, cfg: Models = Models()) -> DataFrame:
    """Adds anomaly_score 0..1 from an isolation forest grown on the same rows. The contamination setting only shifts scores
    before they are stretched to 0..1 and so has no effect."""
    model = fit_anomaly_forest(features, trees, cfg=cfg)
    return anomaly_scores(model, features) if model else features.withColumn("anomaly_score", F.lit(0.0))


def training_rows(features: DataFrame, health: DataFrame, cfg: Models = Models()) -> DataFrame:
    """Features with label (dormant or churned = 1) and holdout mark: one in five of each class, by hash."""
    labelled = features.drop("anomaly_score").join(health.select("rel_id", "health_status", "anomaly_score"), "rel_id")
    return labelled.withColumns({
        "label": F.col("health_status").isin("dormant", "churned").cast("double"),
        "holdout": F.pmod(F.xxhash64("rel_id", F.lit(cfg.seed)), F.lit(5)) == 0})


def fit_switch_classifier(rows: DataFrame, trees: int = 200, depth: int = 6, boosted: bool = True,
                          cfg: Models = Models()) -> PipelineModel | None:
    """Boosted trees (or a forest) on ``training_rows``; positives weighted by negatives // positives. None when too few."""
    train = rows.where(~F.col("holdout"))
    pos, count = train.agg(F.sum("label"), F.count(F.lit(1))).first()
    if not pos or pos < cfg.min_positives or pos == count:
        return None
    weight = max(1, int((count - pos) // pos))
    train = train.withColumn("weight", F.when(F.col("label") == 1, float(weight)).otherwise(1.0))
    shared = dict(labelCol="label", featuresCol="features", weightCol="weight", maxDepth=depth, seed=cfg.seed)
    model = (GBTClassifier(maxIter=trees, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", **shared)
             if boosted else RandomForestClassifier(numTrees=trees, **shared))
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep"), model]).fit(train)


def switch_probability(model: PipelineModel | None, rows: DataFrame) -> DataFrame:
    """(rel_id, probability) of every relationship; unknown where there was too little to train a model on."""
    if model is None:
        return rows.select("rel_id", F.lit(None).cast("double").alias("probability"))
    return model.transform(rows).select("rel_id", vector_to_array("probability")[1].alias("probability"))


def fit_pairwise_ranker(rows: DataFrame, group: str, won: str, features: Sequence[str], cfg: Models = Models()) -> list[float] | None:
    """Weights of a linear ranker from (won, lost) pairs of one group: logistic regression on feature differences.

    A group is one opportunity with at most five candidates, so its pairs are few. Each pair goes
    in both directions, which gives two classes and no intercept. None below the least number of pairs.
    """
    best, rest = rows.where(F.col(won) == 1), rows.where(F.col(won) == 0)
    pairs = best.select(group, *[F.col(f).cast("double").alias(f"w_{f}") for f in features]).join(
        rest.select(group, *[F.col(f).cast("double").alias(f"l_{f}") for f in features]), group)
    both = pairs.select(F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("sign"), *[
        (F.col(f"w_{f}") - F.col(f"l_{f}")).alias(f) for f in features])
    both = both.select(((F.col("sign") + 1) / 2).alias("label"), *[(F.col(f) * F.col("sign")).alias(f) for f in features])
    if both.limit(2 * cfg.min_pairs).count() < 2 * cfg.min_pairs:
        return None
    ready = VectorAssembler(inputCols=list(features), outputCol="features").transform(both)
    return [float(w) for w in LogisticRegression(fitIntercept=False, regParam=0.01).fit(ready).coefficients]


def rank_pairwise(rows: DataFrame, group: str, key: str, features: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """Score (dot product) and rank of every candidate within its group."""
    score = sum((F.col(f).cast("double") * w for f, w in zip(features, weights)), F.lit(0.0))
    scored = rows.withColumn("rank_score", score)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("rank_score"), key)))


def classifier_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row from (label, probability): counts, accuracy, precision, recall, F1 and ROC AUC.

    AUC is the rank sum over distinct probabilities; the running count of negatives is taken
    within 1,000 probability buckets and over the buckets, so no window covers all rows.
    """
    pos, hit = F.col("label") == 1, F.col("probability") >= threshold
    counts = scored.agg(
        F.count_if(pos & hit).alias("tp"), F.count_if(~pos & hit).alias("fp"), F.count_if(~pos & ~hit).alias("tn"),
        F.count_if(pos & ~hit).alias("fn"))
    per = scored.groupBy("probability").agg(F.count_if(pos).alias("p"), F.count_if(~pos).alias("n")).withColumn(
        "b", F.floor(F.col("probability") * 1000))
    inside = Window.partitionBy("b").orderBy("probability").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    buckets = per.groupBy("b").agg(F.sum("n").alias("bn"))  # at most 1,001 rows
    buckets = buckets.withColumn("before", F.coalesce(F.sum("bn").over(
        Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("bn")
    area = per.join(F.broadcast(buckets), "b").agg(
        (F.sum(F.col("p") * (F.col("before") + F.col("below") + F.col("n") / 2)) / F.nullif(
            F.sum("p").cast("double") * F.sum("n"), F.lit(0.0))).alias("auc"))
    row = counts.withColumn("_k", F.lit(1)).join(F.broadcast(area.withColumn("_k", F.lit(1))), "_k").drop("_k")

    def share(part, whole):
        return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    return row.withColumns({
        "accuracy": tidy_round(share(tp + tn, tp + fp + tn + fn), 4), "precision": tidy_round(precision, 4),
        "recall": tidy_round(recall, 4), "f1": tidy_round(share(2 * tp, 2 * tp + fp + fn), 4),
        "roc_auc": tidy_round(F.coalesce("auc", F.lit(0.0)), 4)}).drop("auc")


def ranker_metrics(scored: DataFrame, query: str, score: str, label: str, key: str) -> DataFrame:
    """One row: mean reciprocal rank of the first hit (queries with a hit), NDCG@5 (all queries), queries."""
    by_query = Window.partitionBy(query)
    rows = scored.withColumns({
        "r": F.row_number().over(by_query.orderBy(F.desc(score), key)),
        "ideal": F.row_number().over(by_query.orderBy(F.desc(label), key))})
    gain = F.col(label).cast("double")
    per = rows.groupBy(query).agg(
        F.min(F.when(F.col(label) == 1, F.col("r"))).alias("first"),
        F.sum(F.when(F.col("r") <= 5, gain / F.log2(F.col("r") + 1))).alias("dcg"),
        F.sum(F.when(F.col("ideal") <= 5, gain / F.log2(F.col("ideal") + 1))).alias("idcg"))
    return per.agg(
        tidy_round(F.coalesce(F.avg(1.0 / F.col("first")), F.lit(0.0)), 4).alias("mean_reciprocal_rank"),
        tidy_round(F.avg(F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0)), 4).alias("ndcg_at_5"),
        F.count(F.lit(1)).alias("n_queries"))


def score_explanations(model: PipelineModel | None, rows: DataFrame, top: int | None = None) -> DataFrame:
    """(rel_id, feature, contribution, rank): what each feature adds to a row's log odds (or a forest's probability), by size.

    Contributions are Shapley values of the trees themselves; with the base value they add up to the model's margin.
    Without a model there is nothing to explain and no row.
    """
    if model is None:
        return rows.select("rel_id", F.lit("").alias("feature"), F.lit(0.0).alias("contribution"), F.lit(0).alias("rank")).limit(0)
    return forest_explanations(forest_of(model), rows, top=top)


MODEL_NAMES = ["health_detector", "switch_classifier", "supplier_ranker"]


def model_freshness(runs: DataFrame, as_of, cfg: Models = Models()) -> DataFrame:
    """One row from training runs (model, trained_at): models present, age of the oldest, fresh or not."""
    last = runs.where(F.col("model").isin(*MODEL_NAMES)).groupBy("model").agg(F.max("trained_at").alias("t"))
    row = last.agg(F.count(F.lit(1)).alias("models_present"), F.min("t").alias("oldest"))
    age = whole_days(as_ts(as_of), F.col("oldest"))
    return row.select("models_present", age.alias("oldest_age_days"), F.coalesce(
        (F.col("models_present") == len(MODEL_NAMES)) & (age < cfg.retrain_after_days), F.lit(False)).alias("fresh"))
