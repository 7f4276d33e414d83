"""Unusual branch-months: isolation forest, alert reasons and severity."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.quantiles import exact_quantile
from reviewloom.functions.rows import unnest
from reviewloom.session import ensure_checkpoint_dir

FEATURES = ("review_count", "average_rating", "average_sentiment_score", "negative_ratio")
EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path_length double"
)


@dataclass(frozen=True)
class ForestSettings:
    """Parameters of the model and of eligible rows."""

    contamination: float = 0.1
    seed: int = 42
    trees: int = 100
    sample_size: int = 256
    min_rows: int = 10
    min_review_count: int = 5
    features: Sequence[str] = FEATURES


def eligible_months(features: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """Months with enough reviews and every feature known."""
    return features.where(F.col("review_count") >= settings.min_review_count).dropna(
        subset=list(settings.features)
    )


# -- training ----------------------------------------------------------------


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + EULER_GAMMA
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1)))


def _grow_tree(points: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, path length at a leaf) of one random tree."""
    nodes: list[list] = [[-1, math.nan, -1, -1, 0.0]]
    pending = [(0, points, 0)]
    while pending:
        index, rows, depth = pending.pop()
        spans = np.flatnonzero(np.ptp(rows, axis=0) > 0) if len(rows) > 1 else np.array([])
        if depth >= depth_limit or not len(spans):
            nodes[index][4] = depth + float(_average_path(len(rows)))
            continue
        feature = int(rng.choice(spans))
        column = rows[:, feature]
        threshold = float(rng.uniform(column.min(), column.max()))
        goes_left = column <= threshold
        children = len(nodes), len(nodes) + 1
        nodes.extend([[-1, math.nan, -1, -1, 0.0], [-1, math.nan, -1, -1, 0.0]])
        nodes[index][:4] = feature, threshold, *children
        pending.append((children[0], rows[goes_left], depth + 1))
        pending.append((children[1], rows[~goes_left], depth + 1))
    return [tuple(node) for node in nodes]


def tree_samples(rows: DataFrame, row_count: int, settings: ForestSettings) -> DataFrame:
    """Candidate rows per tree: a hash draw somewhat above the sample size.

    Rows are drawn where they are, so only candidates move: about the sample size per
    tree, whatever the number of rows. The draw exceeds the sample by six standard
    deviations, and each tree keeps the lowest draws.
    """
    wanted = settings.sample_size
    rate = min(1.0, (wanted + 6 * math.sqrt(wanted)) / row_count)
    key = [F.col(c) for c in ("branch_id", "month")]
    scale = 1 << 30

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64(*key, tree, F.lit(settings.seed)), F.lit(scale))

    trees = F.sequence(F.lit(0), F.lit(settings.trees - 1))
    drawn = F.filter(
        F.transform(trees, lambda t: F.struct(t.alias("tree"), draw(t).alias("draw"))),
        lambda d: d["draw"] <= int(rate * scale),
    )
    values = F.array(*(F.col(c).cast("double") for c in settings.features)).alias("point")
    return unnest(rows, drawn, "d", values).select("d.tree", "d.draw", "point")


def train_forest(rows: DataFrame, row_count: int, settings: ForestSettings) -> pd.DataFrame:
    """Grow all trees in parallel, one small group each, and return their nodes.

    The result has at most ``trees * (2 * sample_size - 1)`` rows, independent of the data.
    """
    depth_limit = math.ceil(math.log2(max(min(settings.sample_size, row_count), 2)))
    sample_size, seed = settings.sample_size, settings.seed

    def grow(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(point=frame["point"].map(tuple)).sort_values(["draw", "point"])
        points = np.array(frame["point"].tolist()[:sample_size], dtype=float)
        tree = int(key[0])
        nodes = _grow_tree(points, np.random.default_rng([seed, tree]), depth_limit)
        return pd.DataFrame(
            [(tree, i, *node) for i, node in enumerate(nodes)],
            columns=["tree", "node", "feature", "threshold", "left", "right", "path_length"],
        )

    samples = tree_samples(rows, row_count, settings)
    nodes = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    return nodes.sort_values(["tree", "node"], ignore_index=True)


# -- scoring -----------------------------------------------------------------


def _forest_scorer(nodes: pd.DataFrame, sample_size: int):
    """Arrow function: anomaly score of a row, 1 for the most unusual."""
    first = nodes.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
    offset = nodes["tree"].map(first).to_numpy()
    feature = nodes["feature"].to_numpy()
    threshold = nodes["threshold"].to_numpy()
    left = np.where(feature >= 0, nodes["left"].to_numpy() + offset, 0)
    right = np.where(feature >= 0, nodes["right"].to_numpy() + offset, 0)
    path = nodes["path_length"].to_numpy()
    roots = first.to_numpy()
    normal = float(_average_path(sample_size))

    @F.pandas_udf(T.DoubleType())
    def score(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        rows = np.arange(len(points))[:, None]
        at = np.broadcast_to(roots, (len(points), len(roots))).copy()
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                break
            values = points[rows, np.maximum(feature[at], 0)]
            step = np.where(values <= threshold[at], left[at], right[at])
            at = np.where(inner, step, at)
        depth = path[at].mean(axis=1)
        return pd.Series(np.exp2(-depth / normal) if normal else np.full(len(points), 0.5))

    return score


def model_scores(features: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """Eligible months with ``anomaly_score`` and ``is_anomaly``.

    The score is negative for the chosen share of most unusual rows: the raw score is
    shifted by its own contamination quantile, which is computed exactly.
    """
    ensure_checkpoint_dir(features.sparkSession)
    rows = eligible_months(features, settings).checkpoint()
    row_count = rows.count()
    if row_count < settings.min_rows:
        return rows.withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(False)}).limit(0)
    nodes = train_forest(rows, row_count, settings)
    score = _forest_scorer(nodes, min(settings.sample_size, row_count))
    scored = rows.withColumn("_raw", -score(*(F.col(c) for c in settings.features))).checkpoint()
    offset = exact_quantile(scored, "_raw", settings.contamination)
    decision = F.col("_raw") - offset
    return scored.select(
        *rows.columns, F.round(decision, 6).alias("anomaly_score"), (decision < 0).alias("is_anomaly")
    )


# -- alerts ------------------------------------------------------------------


def with_alerts(months: DataFrame) -> DataFrame:
    """Alert reasons against the previous eligible month of the branch, and severity.

    Needs ``is_anomaly``; rows are branch-months, so one branch is one short window.
    """
    compared = ("average_rating", "negative_ratio", "review_count")
    order = Window.partitionBy("branch_id").orderBy("month")
    before = F.lag(F.struct(*compared)).over(order)
    rating_drop = F.col("average_rating") <= F.col("_before.average_rating") - 0.5
    ratio_rise = F.col("negative_ratio") >= F.col("_before.negative_ratio") + 0.2
    volume = F.try_divide(F.col("review_count"), F.col("_before.review_count"))
    reasons = F.array_compact(
        F.array(
            F.when(rating_drop, F.lit("rating_drop_vs_previous_month")),
            F.when(ratio_rise, F.lit("negative_ratio_rise_vs_previous_month")),
            F.when((volume >= 2.0) | (volume <= 0.5), F.lit("review_volume_shift_vs_previous_month")),
            F.when(F.col("is_anomaly"), F.lit("model_outlier")),
        )
    )
    found = F.col("alert_reasons")
    severity = (
        F.when((F.size(found) >= 2) & F.array_contains(found, "model_outlier"), "high")
        .when(F.size(found) > 0, "medium")
        .otherwise("low")
    )
    return (
        months.withColumn("_before", before)
        .withColumn("alert_reasons", reasons)
        .drop("_before")
        .withColumn("alert_severity", severity)
    )


def rule_alerts(features: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """Alerts from the month-to-month rules alone, without a model."""
    return with_alerts(eligible_months(features, settings).withColumn("is_anomaly", F.lit(False)))


def detect_anomalies(features: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """Scored eligible months with reasons and severity, most unusual first.

    Too few eligible rows give an empty result with the same columns.
    """
    scored = with_alerts(model_scores(features, settings))
    return scored.orderBy("anomaly_score", "branch_id", "month")
