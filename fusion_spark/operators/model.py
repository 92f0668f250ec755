"""Random-forest scoring of candidate fusions."""

from __future__ import annotations

import warnings

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.schemas import (
    BOUNDARY_LEVELS, FRAME_LEVELS, PREDICTION_THRESHOLD, TYPE_LEVELS,
)

LEVELS = {"type": TYPE_LEVELS, "exon_boundary": BOUNDARY_LEVELS, "frame": FRAME_LEVELS}
POSITIVE, NEGATIVE = "positive", "negative"


def prepare_features(df: DataFrame) -> DataFrame:
    """A missing boundary counts as no_match; values outside the fixed levels become NULL."""
    if "exon_boundary" in df.columns:
        df = df.fillna("no_match", ["exon_boundary"])
    for name, levels in LEVELS.items():
        if name in df.columns:
            df = df.withColumn(name, F.when(F.col(name).isin(*levels), F.col(name)))
    return df


def level_indexer(name: str) -> StringIndexerModel:
    """Position of a column's value among its fixed levels, as ``_<name>_idx``.

    An unknown level gets the position after the last one.
    """
    return StringIndexerModel.from_labels(
        list(LEVELS[name]), inputCol=name, outputCol=f"_{name}_idx", handleInvalid="keep"
    )


def missing_features(df: DataFrame, features: list[str]) -> list[str]:
    return sorted(set(features) - set(df.columns))


def fit_model(
    labelled: DataFrame, features: list[str], label: str = "label",
    trees: int = 500, depth: int = 5, seed: int = 42,
) -> PipelineModel:
    """Random forest on a labelled candidate table (label 1.0 = positive)."""
    stages, inputs = [], []
    for name in features:
        if name in LEVELS:
            stages.append(level_indexer(name))
            inputs.append(f"_{name}_idx")
        else:
            inputs.append(name)
    stages.append(
        VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep")
    )
    stages.append(
        RandomForestClassifier(
            featuresCol="_features", labelCol=label, probabilityCol="_probability",
            rawPredictionCol="_raw", predictionCol="_prediction",
            numTrees=trees, maxDepth=depth, seed=seed,
        )
    )
    fitted = Pipeline(stages=stages).fit(prepare_features(labelled))
    # A copy leaves the training summary behind, which would otherwise go to every task
    # together with the session it holds on to.
    *indexing, forest = fitted.stages
    return PipelineModel([*indexing, forest.copy()])


def prediction_class(prob: Column, threshold: float = PREDICTION_THRESHOLD) -> Column:
    return F.when(prob >= threshold, POSITIVE).when(prob < threshold, NEGATIVE)


def score(
    df: DataFrame, model: PipelineModel, features: list[str],
    threshold: float = PREDICTION_THRESHOLD,
) -> DataFrame:
    """Adds ``prediction_prob`` and ``prediction_class``.

    Both are NULL for all rows if a feature column is missing, and for rows without a value
    in one of the features.
    """
    missing = missing_features(df, features)
    if missing:
        warnings.warn(f"features missing from the input: {', '.join(missing)}", stacklevel=2)
        return df.withColumn("prediction_prob", F.lit(None).cast("double")).withColumn(
            "prediction_class", F.lit(None).cast("string")
        )
    complete = F.lit(True)
    for name in features:
        complete = complete & F.col(name).isNotNull()
    scored = model.transform(prepare_features(df)).withColumn(
        "prediction_prob", F.when(complete, vector_to_array("_probability")[1])
    )
    return scored.select(
        *df.columns, "prediction_prob",
        prediction_class(F.col("prediction_prob"), threshold).alias("prediction_class"),
    )


def positives(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction_class") == POSITIVE)
