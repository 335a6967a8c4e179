"""Evaluation as aggregations: the raw predictions never leave the cluster."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, count, share of the label)."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))
    # One row per pair of classes from here on.
    return cells.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy(label)))


def micro_f1(df: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """Micro-averaged F1, which for one label per row is the share of right predictions."""
    right = F.sum(F.when(F.col(label) == F.col(prediction), 1).otherwise(0))
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), right.alias("n_right"))
    return rows.withColumn("micro_f1", F.col("n_right") / F.col("n"))


def binary_metrics(df: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, per group of ``by`` (for instance the split)."""
    def n(actual: int, predicted: int):
        return F.sum(F.when((F.col(label) == actual) & (F.col(prediction) == predicted), 1).otherwise(0))

    counted = df.groupBy(*by).agg(
        n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn")
    )
    ratio = F.try_divide
    return counted.withColumns({
        "accuracy": ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
        "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "f1": ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
    })


def permutation_importance(
    df: DataFrame, row: str, features: Sequence[str], predict: Callable[[DataFrame], DataFrame], label: str, prediction: str, seed: int = 1,
) -> DataFrame:
    """(feature, n, n_wrong, n_wrong_exchanged, importance): how much more often the model errs when a feature is exchanged between rows.

    ``row`` numbers the rows densely from 0 (see ``dense_id``). Row i takes the feature of row
    (a·i + b) mod n, with a prime to n and b by ``seed``: a pairing that needs neither the
    driver nor a sort, and every value is taken once. Rows meet their partners in one join;
    each row then stands once as it is and once per feature, so one pass of ``predict``, which
    adds ``prediction``, tells all. ``importance`` is the difference of the shares of errors: 0
    for a feature the model doesn't read. Rows without a label are left out of the counts,
    but lend their values.
    """
    n = df.count()
    step, shift = _pairing(n, seed)
    at = ((F.col(row).cast("decimal(38,0)") * F.lit(step) + F.lit(shift)) % F.lit(max(1, n))).cast("bigint")
    lent = df.select(F.col(row).alias("_lender"), F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(features)]).alias("_lent"))
    paired = df.where(F.col(label).isNotNull()).withColumn("_partner", at).join(lent, F.col("_partner") == F.col("_lender"))
    variants = paired.withColumn("_feature", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    exchanged = variants.withColumns({
        c: F.when(F.col("_feature") == i, F.col("_lent")[f"f{i}"]).otherwise(F.col(f"`{c}`")) for i, c in enumerate(features)
    }).drop("_partner", "_lender", "_lent")
    wrong = F.count(F.when(~F.col(label).eqNullSafe(F.col(prediction)), 1))
    told = predict(exchanged).groupBy("_feature").agg(F.count(F.lit(1)).alias("n"), wrong.alias("n_wrong_exchanged"))
    # one row per feature and one for the rows as they are from here on
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    beside = told.withColumn("n_wrong", F.max(F.when(F.col("_feature") == -1, F.col("n_wrong_exchanged"))).over(everything)).where("_feature >= 0")
    names = F.array(*[F.lit(c) for c in features])
    return beside.select(
        names[F.col("_feature")].alias("feature"), "n", "n_wrong", "n_wrong_exchanged", ((F.col("n_wrong_exchanged") - F.col("n_wrong")) / F.col("n")).alias("importance"),
    )


def _pairing(n: int, seed: int) -> tuple[int, int]:
    """(a, b) of the pairing i → (a·i + b) mod n: about 0.618 n, the next number prime to n."""
    step = max(1, int(n * 0.6180339887498949))
    while math.gcd(step, max(1, n)) > 1:
        step += 1
    return step, seed % max(1, n)


def _checked(score: str) -> Column:
    """The score; outside [0, 1] it is an error, null stays null."""
    value = F.col(score).cast("double")
    wrong = (value < 0) | (value > 1) | F.isnan(value)
    return F.when(wrong, F.raise_error(F.lit("score outside [0, 1]")).cast("double")).otherwise(value)


def _counts(df: DataFrame, label: str, score: Column) -> DataFrame:
    """Positives and negatives per score, combined map-side; rows without label or score are left out."""
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_y"), score.alias("score")).where("score IS NOT NULL")
    positive = F.sum(F.when(F.col("_y") == 1, 1).otherwise(0))
    return rows.groupBy("score").agg(positive.alias("_p"), (F.count(F.lit(1)) - positive).alias("_q"))


def _accumulated(counts: DataFrame, buckets: int) -> DataFrame:
    """``score, _p, _q, tp, fp, all_p, all_n`` with running counts from the highest score down.

    Scores are cut into ``buckets`` ranges; only the totals of the ranges (at most
    ``buckets + 1`` rows) meet in one place, inside a range the distinct scores are
    ordered by one task each.
    """
    ranged = counts.withColumn("_range", F.floor(F.col("score") * buckets).cast("int"))
    totals = ranged.groupBy("_range").agg(F.sum("_p").alias("_rp"), F.sum("_q").alias("_rq"))
    above = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = totals.select(
        "_range", F.coalesce(F.sum("_rp").over(above), F.lit(0)).alias("_bp"), F.coalesce(F.sum("_rq").over(above), F.lit(0)).alias("_bq"),
        F.sum("_rp").over(everything).alias("all_p"), F.sum("_rq").over(everything).alias("all_n"),
    )
    down = Window.partitionBy("_range").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(before), "_range").select(
        "score", "_p", "_q", (F.col("_bp") + F.sum("_p").over(down)).alias("tp"), (F.col("_bq") + F.sum("_q").over(down)).alias("fp"), "all_p", "all_n",
    )


def roc_points(df: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """ROC and precision-recall points, one per distinct score: the exact curve.

    Scores outside [0, 1] are an error. ``buckets`` only sets how the running counts are
    spread over tasks.
    """
    return _points(_accumulated(_counts(df, label, _checked(score)), buckets))


def binned_roc_points(df: DataFrame, label: str, score: str, bins: int = 100) -> DataFrame:
    """The same at ``bins + 1`` thresholds: scores are rounded down to them, for a curve of bounded length."""
    return _points(_accumulated(_counts(df, label, F.floor(_checked(score) * bins) / bins), bins))


def _points(points: DataFrame) -> DataFrame:
    return points.select(
        F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide("tp", "all_p").alias("recall"), F.try_divide("fp", "all_n").alias("false_positive_rate"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def ranking_metrics(df: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """One row: area under the ROC curve (ties count half), average precision and log loss."""
    points = _accumulated(_counts(df, label, _checked(score)), buckets)
    clipped = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-15)), F.lit(1e-15))
    wins = F.col("_q") * (F.col("tp") - F.col("_p")) + F.col("_q") * F.col("_p") / 2
    return points.agg(
        F.try_divide(F.sum(wins), F.max(F.col("all_p") * F.col("all_n"))).alias("roc_auc"),
        F.try_divide(F.sum(F.col("_p") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.max("all_p")).alias("average_precision"),
        F.try_divide(-F.sum(F.col("_p") * F.log(clipped) + F.col("_q") * F.log1p(-clipped)), F.max(F.col("all_p") + F.col("all_n"))).alias("log_loss"),
    )
