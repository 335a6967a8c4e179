"""Feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F


def split_by_target(df: DataFrame, target: str, drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(labelled, unlabelled) rows of one feature set; ``drop`` removes the other targets."""
    kept = df.drop(*drop)
    return kept.where(F.col(target).isNotNull()), kept.where(F.col(target).isNull())


def class_weights(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """Balanced weight per class, n / (k · n_c), from one map-side-combined count."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("_n"))
    # As many entries as there are classes.
    return (
        counts.agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_k"),
                   F.collect_list(F.struct(target, "_n")).alias("_classes"))
        .select("_total", "_k", F.inline("_classes"))
        .select(target, (F.col("_total") / (F.col("_k") * F.col("_n"))).alias(name))
    )


def with_class_weights(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    return df.join(class_weights(df, target, name), [target], "inner")


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles; text that is not a number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def one_hot_stages(columns: Sequence[str], suffix: str = "_hot", drop_first: bool = True) -> list:
    """Index and one-hot encode columns.

    Levels are ordered descending, so the level left out is the alphabetically
    first one. With ``drop_first=False`` all known levels stay and an unknown one
    becomes all zeros.
    """
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
        stringOrderType="alphabetDesc", handleInvalid="error" if drop_first else "keep",
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}{suffix}" for c in columns],
        dropLast=True, handleInvalid="error" if drop_first else "keep",
    )
    return [indexer, encoder]


def feature_stages(
    numeric: Sequence[str], one_hot: Sequence[str] = (), standardise: bool = False, output: str = "features"
) -> list:
    """Mean-impute numbers, optionally standardise them, one-hot codes, assemble one vector."""
    filled = [f"{c}_filled" for c in numeric]
    stages: list = [Imputer(inputCols=list(numeric), outputCols=filled, strategy="mean")]
    numbers = filled
    if standardise:
        stages += [
            VectorAssembler(inputCols=filled, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
        numbers = ["_scaled"]
    hot: list[str] = []
    if one_hot:
        stages += one_hot_stages(one_hot, drop_first=False)
        hot = [f"{c}_hot" for c in one_hot]
    return stages + [VectorAssembler(inputCols=numbers + hot, outputCol=output)]


def fit_stages(df: DataFrame, stages: Sequence) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)
