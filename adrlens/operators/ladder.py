"""Running counts over scores, ROC points, AUC and class metrics.

Input is a long frame (label, y, score): one row per label and scored row, score in [0, 1].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Two fixed grids over the score, the fine one nested in the coarse one.
COARSE, FINE = 1 << 12, 1 << 24
GROUP = ("label",)


def _above(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Add the counts of all rows with a higher ``order`` in the same group."""
    window = Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(
        Window.unboundedPreceding, -1)
    return df.withColumns({f"{c}_above": F.coalesce(F.sum(c).over(window), F.lit(0))
                           for c in ("pos", "neg")})


def _counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _distinct_scores(scored: DataFrame) -> DataFrame:
    """(label, score, pos, neg, fine, coarse): rows of each distinct score and its bins."""
    y = F.col("y")
    return (
        scored.groupBy("label", "score")
        .agg(F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"),
             F.sum(F.when(y == 1, 0).otherwise(1)).alias("neg"))
        .withColumn("fine", F.floor(F.col("score") * FINE))
        .withColumn("coarse", F.floor(F.col("fine") / (FINE // COARSE)))
    )


def score_ladder(scored: DataFrame) -> DataFrame:
    """Per label and distinct score: positives, negatives and those with a higher score.

    Equal scores collapse in the first aggregate.  The running sum is then taken in three
    levels (coarse bin, fine bin within it, score within that), so no window holds more
    than one bin of its level and no task a whole label.
    """
    scores = _distinct_scores(scored)
    fine = _counts(scores, ["label", "coarse", "fine"])
    coarse = _above(_counts(fine, ["label", "coarse"]), ["label"], "coarse")
    fine = (
        _above(fine, ["label", "coarse"], "fine")
        .join(F.broadcast(coarse.select("label", "coarse", F.col("pos_above").alias("p0"),
                                        F.col("neg_above").alias("n0"))), ["label", "coarse"])
        .select("label", "fine", (F.col("pos_above") + F.col("p0")).alias("p1"),
                (F.col("neg_above") + F.col("n0")).alias("n1"))
    )
    return (
        _above(scores, ["label", "fine"], "score")
        .join(fine, ["label", "fine"])
        .select("label", "score", "pos", "neg", (F.col("pos_above") + F.col("p1")).alias("pos_above"),
                (F.col("neg_above") + F.col("n1")).alias("neg_above"))
    )


def class_totals(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col("y") == 1, 0).otherwise(1)).alias("n_neg"))


def roc_points(scored: DataFrame) -> DataFrame:
    """(label, threshold, tpr, fpr): one point per distinct score, from the origin on.

    The origin has no threshold.  Labels with one class only have no curve.  The totals
    hold one row per label.
    """
    return _curve(scored, score_ladder(scored))


def _next_step(scores: DataFrame) -> DataFrame:
    """(label, score, next): positives and negatives of the next lower score of a label.

    A bin's first step is the next one of the bin before; like the running sums it goes through
    two levels of bins, so no window holds a whole label.
    """
    step = F.struct("pos", "neg")

    def following(by: list[str], order: str, what: Column) -> Column:
        return F.lead(what).over(Window.partitionBy(*by).orderBy(F.desc(order)))

    def first_steps(*by: str) -> DataFrame:
        return scores.groupBy(*by).agg(F.max_by(step, "score").alias("head"))

    coarse = first_steps("label", "coarse").withColumn("after", following(["label"], "coarse", F.col("head"))).drop("head")
    fine = (first_steps("label", "coarse", "fine").withColumn("own", following(["label", "coarse"], "fine", F.col("head")))
            .join(F.broadcast(coarse), ["label", "coarse"])  # at most ``COARSE`` rows per label
            .select("label", "fine", F.coalesce("own", "after").alias("after")))
    return (scores.withColumn("own", following(["label", "fine"], "score", step)).join(fine, ["label", "fine"])
            .select("label", "score", F.coalesce("own", "after").alias("next")))


def roc_corners(scored: DataFrame) -> DataFrame:
    """``roc_points`` without the points that lie between two equal steps of the curve.

    The origin and the points of a label's highest and lowest score always stay.
    """
    steps = _next_step(_distinct_scores(scored))
    highest = F.col("pos_above") + F.col("neg_above") == 0
    bend = F.col("next").isNull() | (F.col("next") != F.struct("pos", "neg"))
    return _curve(scored, score_ladder(scored).join(steps, ["label", "score"]).where(highest | bend).drop("next"))


def _curve(scored: DataFrame, ladder: DataFrame) -> DataFrame:
    totals = class_totals(scored).where("n_pos > 0 AND n_neg > 0")
    hits, alarms = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    points = ladder.join(F.broadcast(totals), "label").select(
        "label", F.col("score").alias("threshold"),
        (hits / F.col("n_pos")).alias("tpr"), (alarms / F.col("n_neg")).alias("fpr"))
    origin = totals.select("label", F.lit(None).cast("double").alias("threshold"),
                           F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return points.unionByName(origin)


def auc(scored: DataFrame) -> DataFrame:
    """(label, auc): share of positive-negative pairs ranked right, ties count half.

    Zero when a label has one class only.
    """
    wins = F.sum(F.col("neg") * F.col("pos_above") + F.col("neg") * F.col("pos") / 2.0)
    n_pos, n_neg = F.sum("pos"), F.sum("neg")
    return score_ladder(scored).groupBy("label").agg(
        F.coalesce(F.try_divide(wins, n_pos.cast("double") * n_neg), F.lit(0.0)).alias("auc"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def classification_metrics(predicted: DataFrame) -> DataFrame:
    """Confusion counts, precision, recall and F1 per label; input (label, y, prediction)."""
    y, p = F.col("y") == 1, F.col("prediction") == 1

    def cell(test: Column, name: str) -> Column:
        return F.sum(F.when(test, 1).otherwise(0)).alias(name)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        predicted.groupBy("label")
        .agg(cell(y & p, "tp"), cell(~y & p, "fp"), cell(y & ~p, "fn"), cell(~y & ~p, "tn"))
        .select("label", "tp", "fp", "fn", "tn", _ratio(tp, tp + fp).alias("precision"),
                _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
    )


def hard_label_auc(metrics: DataFrame) -> DataFrame:
    """AUC of the hard classes, from confusion counts: the mean of recall and specificity."""
    n_pos, n_neg = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    value = (_ratio(F.col("tp"), n_pos) + _ratio(F.col("tn"), n_neg)) / 2
    return metrics.select("label", F.when((n_pos > 0) & (n_neg > 0), value).otherwise(0.0)
                          .alias("auc"))


def verdict(performance: DataFrame) -> DataFrame:
    """Mean metrics over labels and the quality band of the mean test AUC."""
    mean = F.col("mean_test_auc")
    return (
        performance.agg(*[F.avg(c).alias(f"mean_{c}")
                          for c in ("test_auc", "precision", "recall", "f1")])
        .withColumn("verdict", F.when(mean >= 0.75, "EXCELLENT").when(mean >= 0.70, "GOOD")
                    .when(mean >= 0.65, "FAIR").otherwise("WEAK"))
    )
