"""Clustering of the positive cases: projection, elbow curve, k-means and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.functions.moments import VECTOR_SCHEMA, add_up, batch_matrix, pack, unpack, vector_batch
from surveyflow.operators.encode import fit_scale, scale


def positives(df: DataFrame, label: str = "match") -> DataFrame:
    return df.filter(quoted(label) == 1)


def standardized_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``features``: the standardised columns as a vector. Rows need to be complete."""
    names = [f"__{c}" for c in columns]
    numbers = df.select("*", *[quoted(c).cast("double").alias(n) for c, n in zip(columns, names, strict=True)])
    scaled = scale(numbers, fit_scale(numbers, names))
    return VectorAssembler(inputCols=names, outputCol="features").transform(scaled).drop(*names)


@dataclass(frozen=True)
class Axes:
    """Principal components of standardised columns: directions by falling variance, each with its largest part positive."""

    columns: list[str]
    means: np.ndarray
    spreads: np.ndarray
    directions: np.ndarray
    variances: np.ndarray


def _moment_sums(columns: list[str]):
    """Task function: product sums of [1, row] about the row's block, one vector a task."""

    def run(batches):
        size = len(columns) + 1
        total = np.zeros(size * (size + 1) // 2)
        for batch in batches:
            rows = np.hstack([np.ones((batch.num_rows, 1)), batch_matrix(batch, columns)])
            rows = rows[~np.isnan(rows).any(1)]
            total += pack(rows.T @ rows)
        yield vector_batch({0: total})

    return run


def principal_axes(df: DataFrame, columns: Sequence[str], k: int = 2) -> Axes:
    """From product sums over all complete rows, in two passes: the means, then products about them.

    Passes return a vector of p * p / 2 sums; rows are neither stored nor moved. A constant column has no direction.
    """
    names = list(columns)
    numbers = df.select(*[quoted(c).cast("double").alias(c) for c in names])
    complete = numbers.na.drop()
    first = complete.agg(F.count(F.lit(1)).alias("n"), *[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    if not first["n"]:
        raise ValueError("no complete row")
    means = np.array([first[f"m{i}"] for i in range(len(names))])
    centred = complete.select(*[(quoted(c) - float(m)).alias(c) for c, m in zip(names, means, strict=True)])
    sums = unpack(add_up(centred.mapInArrow(_moment_sums(names), VECTOR_SCHEMA))[0][0], len(names) + 1)
    products = sums[1:, 1:] / first["n"]
    spreads = np.sqrt(np.diag(products))
    spreads = np.where(spreads > 1e-12 * np.maximum(np.abs(means), 1.0), spreads, np.inf)
    values, vectors = np.linalg.eigh(products / np.outer(spreads, spreads))
    order = np.argsort(-values, kind="stable")[:k]
    directions = vectors[:, order].T
    largest = np.abs(directions).argmax(1)
    directions *= np.sign(directions[np.arange(len(directions)), largest])[:, None]
    return Axes(names, means, spreads, directions, values[order])


def projected(df: DataFrame, axes: Axes, keys: Sequence[str]) -> DataFrame:
    """Keys and the coordinates of each complete row on the axes, by plain arithmetic."""
    complete = df.select(*[quoted(k) for k in keys], *[quoted(c).cast("double").alias(f"__{c}") for c in axes.columns])
    complete = complete.na.drop(subset=[f"__{c}" for c in axes.columns])
    parts = []
    for number, direction in enumerate(axes.directions, 1):
        terms = [
            (quoted(f"__{c}") - float(m)) * float(w / s)
            for c, m, s, w in zip(axes.columns, axes.means, axes.spreads, direction, strict=True)
        ]
        parts.append(reduce(lambda a, b: a + b, terms).alias(f"pc{number}"))
    return complete.select(*[quoted(k) for k in keys], *parts)


def project(df: DataFrame, columns: Sequence[str], keys: Sequence[str], k: int = 2) -> DataFrame:
    """Keys and the first ``k`` principal components, for plotting."""
    return projected(df, principal_axes(df, columns, k), keys)


def fit_clusters(vectors: DataFrame, k: int, seed: int = 42) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int = 42) -> DataFrame:
    """(k, wss): within-cluster sum of squares for each number of clusters."""
    vectors = standardized_vectors(df, columns).select("features").persist()
    try:
        costs = [(int(k), float(fit_clusters(vectors, k, seed).summary.trainingCost)) for k in ks]
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(costs, "k int, wss double")


def with_clusters(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Add the k-means label of each row."""
    vectors = standardized_vectors(df, columns)
    return fit_clusters(vectors, k, seed).transform(vectors).drop("features")


def assign(df: DataFrame, centroids: Sequence[dict[str, float]], name: str = "cluster") -> DataFrame:
    """Label each row with its nearest given centroid; the first one wins a tie."""
    distances = [
        F.struct(
            sum(((quoted(c) - value) * (quoted(c) - value) for c, value in centroid.items()), F.lit(0.0)).alias("d"),
            F.lit(i).alias("i"),
        )
        for i, centroid in enumerate(centroids)
    ]
    return df.withColumn(name, F.array_min(F.array(*distances)).i)


def cluster_profile(df: DataFrame, columns: Sequence[str], cluster: str = "cluster", digits: int = 6) -> DataFrame:
    """Row count and means per cluster."""
    return df.groupBy(quoted(cluster)).agg(
        F.count(F.lit(1)).alias("rows"), *[F.round(F.avg(quoted(c)), digits).alias(f"avg_{c}") for c in columns]
    )


def lloyd(
    df: DataFrame, columns: Sequence[str], centroids: Sequence[dict[str, float]], rounds: int, digits: int | None = None
) -> list[dict[str, float]]:
    """Centroids after so many rounds from given ones; each round is one aggregate, of a row per cluster.

    A cluster without rows keeps its centroid. ``digits`` rounds the centroids after each round.
    """
    current = [dict(c) for c in centroids]
    for _ in range(rounds):
        sums = assign(df, current).groupBy("cluster").agg(*[F.avg(quoted(c)).alias(c) for c in columns])
        for row in sums.collect():
            current[row["cluster"]] = {c: row[c] if digits is None else round(row[c], digits) for c in columns}
    return current


def settle(
    df: DataFrame, columns: Sequence[str], centroids: Sequence[dict[str, float]], digits: int = 6, most: int = 200
) -> tuple[list[dict[str, float]], bool]:
    """Rounds from given centroids until none moves any more, and whether that point was reached.

    There each centroid is the rounded mean of the rows nearest to it, so another round changes nothing.
    """
    current = [{c: round(v, digits) for c, v in centroid.items()} for centroid in centroids]
    for _ in range(most):
        moved = lloyd(df, columns, current, 1, digits)
        if moved == current:
            return current, True
        current = moved
    return current, False


def settled_clusters(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42, digits: int = 6) -> tuple[list[dict[str, float]], bool]:
    """k-means in the columns' own units: a parallel start, then rounds until the centroids rest."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(df.na.drop(subset=list(columns)))
    centres = fit_clusters(vectors, k, seed).clusterCenters()
    return settle(df, columns, [dict(zip(columns, map(float, c), strict=True)) for c in centres], digits)


def within_cost(df: DataFrame, centroids: Sequence[dict[str, float]]) -> DataFrame:
    """One row: the sum of squared distances to the nearest of the given centroids."""
    distances = [
        sum(((quoted(c) - value) * (quoted(c) - value) for c, value in centroid.items()), F.lit(0.0))
        for centroid in centroids
    ]
    return df.agg(F.sum(F.array_min(F.array(*distances))).alias("wss"))
