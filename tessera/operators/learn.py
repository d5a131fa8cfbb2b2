"""Walk-forward boosted trees with Spark's own estimator. It is not the histogram estimator of other libraries, so scores differ."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def boosted_walk_forward(rows: DataFrame, features: list[str], label: str, period: str, label_end: str, periods: list[int], trees: int = 20, depth: int = 3, seed: int = 1) -> DataFrame:
    """Scores of the rows of each period by a model of the rows whose label ended before it; other columns stay.

    Each fit is one distributed training over all earlier rows. Rows with a null feature are not scored.
    """
    known = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip").transform(rows)
    parts = []
    for p in periods:
        past = known.where((F.col(label_end) < p) & F.col(label).isNotNull())
        if past.limit(20).count() < 20:
            continue
        model = GBTRegressor(featuresCol="_x", labelCol=label, predictionCol="score", maxIter=trees, maxDepth=depth, seed=seed).fit(past)
        parts.append(model.transform(known.where(F.col(period) == p)).select(*rows.columns, "score"))
    if not parts:
        return rows.limit(0).withColumn("score", F.lit(None).cast("double"))
    return reduce(DataFrame.unionByName, parts)
