"""Evaluation of binary predictions: rows hold a 0/1 label and a 0/1 prediction or a score.

Everything that depends on the confusion matrix needs one aggregation with four counters. The functions
named `..._of_counts` start from its row, those named `..._of_tally` from (score, pos, neg) rows: one per
prediction, or one per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prospectra.functions import named, nan_to_null, safe_ratio

LABEL, PREDICTION, SCORE = "y_true", "y_pred", "y_proba"

# The threshold search tries 100 evenly spaced points from 0 to 1.
_STEPS = 99
# The score histogram has 50 bins.
_BINS = 50
# Names of the classes in reports.
_CLASS_NAMES = ("Non-Customer", "Customer")


def threshold_predictions(scored: DataFrame, threshold: float = 0.5, score: str = SCORE) -> DataFrame:
    """Add the 0/1 prediction: score at or above the threshold; NULL where the score is NULL or NaN."""
    return scored.withColumn(PREDICTION, (nan_to_null(named(score)) >= threshold).cast("int"))


def confusion_counts(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = named(label), named(prediction)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def counts_at(tally: DataFrame, threshold: float) -> DataFrame:
    """`confusion_counts` of predictions at a threshold, from a tally without NULL or NaN scores."""
    yes, zero = F.col("score") >= threshold, F.lit(0).cast("bigint")

    def total(column: str, hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col(column))), zero)

    return tally.agg(
        total("neg", ~yes).alias("tn"),
        total("neg", yes).alias("fp"),
        total("pos", ~yes).alias("fn"),
        total("pos", yes).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row per true class: predicted_0, predicted_1."""
    return matrix_of_counts(confusion_counts(df, label, prediction))


def matrix_of_counts(counts: DataFrame) -> DataFrame:
    def row(actual: int, no: str, yes: str) -> Column:
        return F.struct(
            F.lit(actual).alias("actual"),
            F.col(no).alias("predicted_0"),
            F.col(yes).alias("predicted_1"),
        )

    return counts.select(F.inline(F.array(row(0, "tn", "fp"), row(1, "fn", "tp"))))


def _precision(tp: Column, fp: Column) -> Column:
    return safe_ratio(tp, tp + fp)


def _recall(tp: Column, fn: Column) -> Column:
    return safe_ratio(tp, tp + fn)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return safe_ratio(tp * 2, tp * 2 + fp + fn)


def classification_metrics(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """One row: accuracy, precision, recall, f1; an empty denominator gives 0."""
    return metrics_of_counts(confusion_counts(df, label, prediction))


def metrics_of_counts(counts: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _precision(tp, fp).alias("precision"),
        _recall(tp, fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1"),
    )


def classification_report(
    df: DataFrame,
    label: str = LABEL,
    prediction: str = PREDICTION,
    names: tuple[str, str] = _CLASS_NAMES,
) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted averages."""
    return report_of_counts(confusion_counts(df, label, prediction), names)


def report_of_counts(counts: DataFrame, names: tuple[str, str] = _CLASS_NAMES) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    no = (_precision(tn, fn), _recall(tn, fp), _f1(tn, fn, fp))
    yes = (_precision(tp, fp), _recall(tp, fn), _f1(tp, fp, fn))
    n_no, n_yes = tn + fp, fn + tp
    total = n_no + n_yes
    accuracy = safe_ratio(tn + tp, total)
    macro = [(a + b) / 2 for a, b in zip(no, yes)]
    weighted = [safe_ratio(a * n_no + b * n_yes, total) for a, b in zip(no, yes)]
    nothing = F.lit(None).cast("double")
    lines = [
        line(names[0], *no, n_no),
        line(names[1], *yes, n_yes),
        line("accuracy", nothing, nothing, accuracy, total),
        line("macro avg", *macro, total),
        line("weighted avg", *weighted, total),
    ]
    return counts.select(F.inline(F.array(*lines)))


def business_metrics(
    df: DataFrame,
    label: str = LABEL,
    prediction: str = PREDICTION,
    conversion_value: float = 100.0,
    contact_cost: float = 1.0,
) -> DataFrame:
    """One row: contacts, conversions and what they earn and cost."""
    return business_of_counts(confusion_counts(df, label, prediction), conversion_value, contact_cost)


def business_of_counts(
    counts: DataFrame, conversion_value: float = 100.0, contact_cost: float = 1.0
) -> DataFrame:
    contacts, hits, missed = F.col("fp") + F.col("tp"), F.col("tp"), F.col("fn")
    revenue, cost = hits * F.lit(conversion_value), contacts * F.lit(contact_cost)
    return counts.select(
        contacts.alias("total_contacts"),
        hits.alias("successful_conversions"),
        missed.alias("missed_conversions"),
        revenue.alias("revenue"),
        cost.alias("cost"),
        (revenue - cost).alias("profit"),
        F.when(cost > 0, F.try_divide(revenue - cost, cost) * 100).otherwise(0.0).alias("roi_percent"),
        _precision(hits, F.col("fp")).alias("precision"),
        _recall(hits, missed).alias("recall"),
    )


def tally_rows(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Predictions as a tally, one row each; a label other than 0 and 1 counts for nothing."""
    y = named(label)
    return scored.select(
        named(score).alias("score"),
        F.coalesce((y == 1).cast("bigint"), F.lit(0)).alias("pos"),
        F.coalesce((y == 0).cast("bigint"), F.lit(0)).alias("neg"),
    )


def threshold_scores(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """f1, precision and recall at each of the 100 thresholds, from one pass over the rows.

    A NULL score reaches no threshold.
    """
    return thresholds_of_tally(tally_rows(scored, label, score))


def thresholds_of_tally(tally: DataFrame) -> DataFrame:
    """`threshold_scores` of a tally.

    Each row falls into the cell of the highest threshold it reaches. The cells, 101 at most, are
    then summed from the top: the window below sees no more rows than that.
    """
    p, step = F.col("score"), F.lit(1.0 / _STEPS)
    guess = F.floor(F.least(F.greatest(p * _STEPS, F.lit(-1.0)), F.lit(float(_STEPS)))).cast("int")

    def point(i: Column) -> Column:
        return F.when(i >= _STEPS, F.lit(1.0)).otherwise(i * step)

    # The product may round to a neighbouring cell; compare with the thresholds themselves.
    cell = (
        F.when((guess >= 0) & (p < point(guess)), guess - 1)
        .when((guess < _STEPS) & (p >= point(guess + 1)), guess + 1)
        .otherwise(guess)
    )
    cells = tally.groupBy(cell.alias("cell")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid = tally.sparkSession.range(-1, _STEPS + 1, numPartitions=1)
    grid = grid.select(F.col("id").cast("int").alias("cell"))
    from_top = Window.partitionBy(F.lit(0)).orderBy(F.desc("cell"))
    counted = (
        grid.join(F.broadcast(cells), "cell", "left")
        .fillna(0, ["pos", "neg"])
        .select(
            "cell",
            F.sum("pos").over(from_top).alias("tp"),
            F.sum("neg").over(from_top).alias("fp"),
            F.sum("pos").over(Window.partitionBy(F.lit(0))).alias("positives"),
        )
        .where(F.col("cell") >= 0)
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("positives") - tp
    return counted.select(
        point(F.col("cell")).alias("threshold"),
        _f1(tp, fp, fn).alias("f1"),
        _precision(tp, fp).alias("precision"),
        _recall(tp, fn).alias("recall"),
    )


METRICS = ("f1", "precision", "recall")


def optimal_thresholds(
    scored: DataFrame, label: str = LABEL, score: str = SCORE, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """(metric, threshold, value): per metric the threshold with the best value, the lowest of equals;
    (0.5, 0) if none is above 0. One pass over the rows for all metrics."""
    return best_thresholds(threshold_scores(scored, label, score), metrics)


def best_thresholds(thresholds: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """`optimal_thresholds` of a table of `threshold_scores`."""
    bests = []
    for metric in metrics:
        rank = F.struct(F.col(metric).alias("value"), (-F.col("threshold")).alias("low"))
        best = F.max(F.when(F.col(metric) > 0, rank))
        bests.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.coalesce(-best["low"], F.lit(0.5)).alias("threshold"),
                F.coalesce(best["value"], F.lit(0.0)).alias("value"),
            )
        )
    return thresholds.agg(F.array(*bests).alias("bests")).select(F.inline("bests"))


def optimal_threshold(
    scored: DataFrame, metric: str = "f1", label: str = LABEL, score: str = SCORE
) -> DataFrame:
    """One row: the threshold with the best metric, as `optimal_thresholds` finds it."""
    if metric not in METRICS:
        raise ValueError(f"Unsupported metric: {metric}; use f1, precision or recall")
    return optimal_thresholds(scored, label, score, [metric]).drop("metric")


def score_histogram(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """(actual, bin, lower, upper, n): 50 equal bins per true class, over the class's own range.

    The last bin includes its upper end. A class with a single score gets a range of width 1.
    """
    return histogram_of_tally(tally_rows(scored, label, score))


def histogram_of_tally(tally: DataFrame) -> DataFrame:
    classes = [
        F.struct(F.lit(actual).alias("actual"), F.col(column).alias("n"))
        for actual, column in enumerate(("neg", "pos"))
    ]
    rows = tally.where(F.col("score").isNotNull()).select("score", F.inline(F.array(*classes))).where("n > 0")
    p, low, high = F.col("score"), F.col("low"), F.col("high")
    ends = rows.groupBy("actual").agg(F.min(p).alias("low"), F.max(p).alias("high"))
    half = F.when(low == high, 0.5).otherwise(0.0)
    ends = ends.select("actual", (low - half).alias("low"), (high + half).alias("high"))
    width = (high - low) / F.lit(float(_BINS))

    def edge(i: Column) -> Column:
        return F.when(i >= _BINS, high).otherwise(low + i * width)

    guess = F.least(F.floor((p - low) / (high - low) * _BINS).cast("int"), F.lit(_BINS - 1))
    bin_ = (
        F.when(p < edge(guess), guess - 1)
        .when((guess < _BINS - 1) & (p >= edge(guess + 1)), guess + 1)
        .otherwise(guess)
    )
    # `ends` has one row per class, two at most.
    placed = rows.join(F.broadcast(ends), "actual").select("actual", bin_.alias("bin"), "n")
    counts = placed.groupBy("actual", "bin").agg(F.sum("n").alias("n"))
    bins = ends.select(
        "actual", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(_BINS - 1))).alias("bin")
    )
    return bins.join(F.broadcast(counts), ["actual", "bin"], "left").select(
        "actual",
        "bin",
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )
