"""Accuracy of predictions. Everything follows from one count per pair of true and predicted class.

``pairs`` below has ``y_true, y_pred``; rows with a null in either are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``y_true, y_pred, n``: at most the square of the number of classes."""
    return pairs.filter("y_true IS NOT NULL AND y_pred IS NOT NULL").groupBy("y_true", "y_pred").agg(F.count("*").alias("n"))


def _classes(counts: DataFrame) -> DataFrame:
    return counts.select(F.col("y_true").alias("c")).union(counts.select("y_pred")).distinct()


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """``y_true, y_pred, n`` for all pairs of classes that occur on either side, zeros included.

    Classes are few; only they are crossed.
    """
    counts = pair_counts(pairs)
    classes = _classes(counts)
    grid = classes.withColumnRenamed("c", "y_true").crossJoin(classes.withColumnRenamed("c", "y_pred"))
    return grid.join(counts, ["y_true", "y_pred"], "left").select("y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_matrix_wide(pairs: DataFrame) -> DataFrame:
    """One row per true class, one column ``p_<class>`` per predicted class, in class order."""
    matrix = confusion_matrix(pairs)
    classes = [r["y_true"] for r in matrix.select("y_true").distinct().orderBy("y_true").collect()]
    wide = matrix.groupBy("y_true").pivot("y_pred", classes).agg(F.first("n")) if classes else matrix.select("y_true")
    return wide.toDF("y_true", *[f"p_{c}" for c in classes])


def _per_class(pairs: DataFrame) -> DataFrame:
    """``c, tp, support, predicted`` of every class on either side."""
    counts = pair_counts(pairs)
    sides = counts.select(F.col("y_true").alias("c"), "n", F.lit(0).alias("p"), F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("hit"))
    sides = sides.union(counts.select("y_pred", F.lit(0), "n", F.lit(0)))
    return sides.groupBy("c").agg(F.sum("hit").alias("tp"), F.sum("n").alias("support"), F.sum("p").alias("predicted"))


def _or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _class_scores(pairs: DataFrame) -> DataFrame:
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return _per_class(pairs).select(
        "c", "tp", "support", "predicted", _or_zero(tp, predicted).alias("precision"), _or_zero(tp, support).alias("recall"), _or_zero(2 * tp, support + predicted).alias("f1")
    )


def accuracy(pairs: DataFrame) -> DataFrame:
    """``accuracy``: correct rows over all rows."""
    counts = pair_counts(pairs)
    return counts.agg(F.try_divide(F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)), F.sum("n")).alias("accuracy"))


def balanced_accuracy(pairs: DataFrame) -> DataFrame:
    """``balanced_accuracy``: the mean recall of the classes that are true somewhere."""
    return _class_scores(pairs).filter("support > 0").agg(F.avg("recall").alias("balanced_accuracy"))


def cohen_kappa(pairs: DataFrame) -> DataFrame:
    """``kappa``: agreement beyond that expected from the margins."""
    one = _per_class(pairs).agg(F.sum("tp").alias("tp"), F.sum("support").alias("n"), F.sum(F.col("support").cast("double") * F.col("predicted")).alias("margins"))
    observed, expected = F.try_divide("tp", "n"), F.try_divide(F.col("margins"), F.col("n").cast("double") * F.col("n"))
    return one.select(F.try_divide(observed - expected, 1 - expected).alias("kappa"))


def macro_f1(pairs: DataFrame) -> DataFrame:
    """``macro_f1``: the unweighted mean F1 of the classes on either side; an undefined F1 is 0."""
    return _class_scores(pairs).agg(F.avg("f1").alias("macro_f1"))


def classification_report(pairs: DataFrame) -> DataFrame:
    """``name, precision, recall, f1, support, balanced_accuracy, cohen_kappa``.

    A row for every class, then ``accuracy`` (its value in every column), ``macro avg``
    and ``weighted avg``. The last two columns are the same in all rows.
    """
    scores = _class_scores(pairs)
    rows = scores.select(F.col("c").cast("string").alias("name"), "precision", "recall", "f1", F.col("support").cast("double").alias("support"))
    acc = accuracy(pairs).select(F.lit("accuracy").alias("name"), *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1", "support")])
    macro = scores.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").cast("double").alias("support"))
    weighted = scores.agg(*[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").cast("double").alias("support"))
    out = rows.unionByName(acc)
    for name, one in (("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(one.select(F.lit(name).alias("name"), "precision", "recall", "f1", "support"))
    both = balanced_accuracy(pairs).crossJoin(cohen_kappa(pairs).withColumnRenamed("kappa", "cohen_kappa"))
    return out.crossJoin(F.broadcast(both))


def drop_unseen_classes(val: DataFrame, train: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """Validation rows of classes that were trained on, and ``label, n`` of the others."""
    seen = train.select(F.col(label).alias("_label")).filter("_label IS NOT NULL").distinct()
    same = F.col(label) == F.col("_label")
    return val.join(seen, same, "left_semi"), val.join(seen, same, "left_anti").groupBy(label).agg(F.count("*").alias("n"))


def missing_predictions(pairs: DataFrame) -> DataFrame:
    """``y_true``: classes that are true somewhere and predicted nowhere."""
    counts = pair_counts(pairs)
    return counts.select("y_true").distinct().subtract(counts.select("y_pred").distinct())
