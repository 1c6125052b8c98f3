"""Quality rules: counts per document, and robust outliers among them per language and source.

Documents are described by four transformed statistics. Each language and source gets a minimum-covariance-
determinant estimate: concentration steps keep the half of its documents nearest to the centre, by Mahalanobis
distance, and estimate centre and covariance anew from them. A document is rejected if its distance from the
final, reweighted estimate is too large. Groups too small for an estimate of their own are pooled by language,
and if that is too small as well, all together.

A step is one aggregate over the statistics, by group and bin of distance: the nearest half is made of whole
bins, so no group is sorted or gathered. Statistics are whole numbers (thousandths), so that their sums do not
depend on the order of tasks. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prospectra.sources.scratch import materialize

_SPACE = r"[\x20\x09-\x0D]+"
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50

#: Documents of a group below which it is pooled.
MIN_GROUP = 200
#: Share of a group that a concentration step keeps, and the number of steps.
KEPT_SHARE, STEPS = 0.5, 5
#: Squared distance beyond which a document is an outlier, and beyond which it is left out of the final
#: estimate (the 0.975 quantile of the chi-square distribution of four degrees).
CUTOFF, REWEIGHT = 60.0, 11.143
#: Covariance of normally distributed statistics over that of their nearest half: 0.5 / 0.2371.
CONSISTENCY = 2.109
#: Least standard deviation of each transformed statistic: differences below it say nothing of quality.
FLOORS = {"x1": 400.0, "x2": 40.0, "x3": 60.0, "x4": 60.0}
FEATURES = list(FLOORS)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Bins of distance per doubling, and the last one.
_BINS, _LAST_BIN = 16, 512


def document_statistics(docs: DataFrame, text_col: str = "text", carried: list[Column] | None = None) -> DataFrame:
    """`row` (all columns of the input, or the `carried` ones), `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`.

    Null texts count as empty: all counts are 0. Texts are taken whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(*(carried or ["*"]))
    split = docs.select(row.alias("row"), text.alias("text")).select(
        "row",
        F.filter(F.split("text", _SPACE), lambda word: word != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
    )
    windows = F.when(
        F.size("words") > 2,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.col("n_symbols").cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    return hashed.withColumn(
        "n_repeat_words",
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0))
        .otherwise(_repeated_words(F.col("windows")))
        .cast("bigint"),
    ).drop("windows")


def _bound(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(windows: Column) -> Column:
    """Words that lie in a window found twice or more: windows are sorted, equal neighbours marked."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(sorted_windows: Column) -> Column:
        again = F.filter(
            F.transform(
                sorted_windows,
                lambda w, k: F.when(
                    (F.get(sorted_windows, k - 1)["h"] == w["h"]) | (F.get(sorted_windows, k + 1)["h"] == w["h"]),
                    w["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2)))))

    return _bound(placed, covered)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def transformed() -> dict[str, Column]:
    """The statistics the estimates are made of, in thousandths."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = {
        "x1": F.log1p(F.col("word_chars") / words),
        "x2": F.log1p(F.col("n_symbols") / words),
        "x3": F.log1p(F.col("n_dup_lines") / F.sqrt(words)),
        "x4": F.sqrt(F.col("n_repeat_words") / words),
    }
    return {name: F.round(value * 1000).cast("double") for name, value in values.items()}


def _sums() -> list[Column]:
    """Number, sums and sums of products of the statistics."""
    products = [
        F.sum(F.col(a) * F.col(b)).alias(f"s_{a}{b}") for i, a in enumerate(FEATURES) for b in FEATURES[i:]
    ]
    return [F.count(F.lit(1)).cast("double").alias("n"), *(F.sum(x).alias(f"s_{x}") for x in FEATURES), *products]


_SUMS = ["n", *(f"s_{x}" for x in FEATURES), *(f"s_{a}{b}" for i, a in enumerate(FEATURES) for b in FEATURES[i:])]


def _estimate(sums: DataFrame, key: str) -> DataFrame:
    """Centre `m_x` and the factors of the covariance (unit lower triangle `l_xy`, diagonal `d_x`) per group."""
    means = {x: F.col(f"s_{x}") / F.col("n") for x in FEATURES}
    cov = {
        (a, b): F.col(f"s_{a}{b}") / F.col("n") - means[a] * means[b] for i, a in enumerate(FEATURES) for b in FEATURES[i:]
    }
    named = sums.select(
        key,
        *(means[x].alias(f"m_{x}") for x in FEATURES),
        *((c + (FLOORS[a] ** 2 if a == b else 0.0)).alias(f"c_{a}{b}") for (a, b), c in cov.items()),
    )
    for j, x in enumerate(FEATURES):  # the usual recursion, one column at a time
        pivot = F.col(f"c_{x}{x}")
        for y in FEATURES[:j]:
            pivot = pivot - F.col(f"l_{x}{y}") * F.col(f"l_{x}{y}") * F.col(f"d_{y}")
        named = named.withColumn(f"d_{x}", F.greatest(pivot, F.lit(1e-6)))
        for z in FEATURES[j + 1 :]:
            entry = F.col(f"c_{x}{z}")
            for y in FEATURES[:j]:
                entry = entry - F.col(f"l_{z}{y}") * F.col(f"l_{x}{y}") * F.col(f"d_{y}")
            named = named.withColumn(f"l_{z}{x}", entry / F.col(f"d_{x}"))
    return named.select(key, *(c for c in named.columns if c[:2] in ("m_", "l_", "d_")))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: dict[str, Column] = {}
    for j, x in enumerate(FEATURES):
        value = F.col(x) - F.col(f"m_{x}")
        for y in FEATURES[:j]:
            value = value - F.col(f"l_{x}{y}") * solved[y]
        solved[x] = value
    total = F.lit(0.0)
    for x in FEATURES:
        total = total + solved[x] * solved[x] / F.col(f"d_{x}")
    return total


def _with(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(estimates, "group").withColumn("distance", _distance())


def _groups(rows: DataFrame, lang_col: str, source_col: str, min_group: int) -> DataFrame:
    """`lang_col`, `source_col`, `group`: the number of the group each language and source belongs to.

    Small ones are pooled by language, and small pools in one for all.
    """
    sizes = rows.groupBy(lang_col, source_col).agg(F.sum(F.when(~F.col("failed"), 1).otherwise(0)).alias("n"))
    name = F.to_json(F.struct(F.col(lang_col).alias("l"), F.col(source_col).alias("s")))
    pool = F.to_json(F.struct(F.col(lang_col).alias("l"), F.lit(True).alias("pooled")))
    small = sizes.withColumn("group", F.when(F.col("n") >= min_group, name))
    pooled = F.sum(F.when(F.col("group").isNull(), F.col("n"))).over(Window.partitionBy(lang_col))
    return small.select(
        F.col(lang_col).alias("of_lang"),
        F.col(source_col).alias("of_source"),
        F.coalesce("group", F.when(pooled >= min_group, pool), F.lit("all")).alias("group"),
    )


def judge(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
    cutoff: float = CUTOFF,
    columns: list[str] | None = None,
) -> DataFrame:
    """`row` (all columns of the input, or the chosen ones), the counts, `base_failed`, `distance`, `kept` for every row.

    A document is kept if it passes the base rules and its squared distance is at most `cutoff`. Documents that
    fail the base rules take no part in the estimates, and their distance is null. A null language or source is
    a value like others; repeated rows are judged alike; an empty table gives no rows.
    """
    carried = [
        F.struct(*(columns or ["*"])).alias("row"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
    ]
    counted = document_statistics(docs, text_col, carried).select(
        "row.row",
        "row.lang",
        "row.source",
        *COUNTS,
        base_failed().alias("failed"),
    )
    counted = materialize(counted.select("*", *(x.alias(name) for name, x in transformed().items())), "statistics")
    numbers = counted.select("lang", "source", "failed", *FEATURES)
    groups = materialize(_groups(numbers, "lang", "source", min_group), "groups")
    grouped = _in_group(numbers.where("NOT failed"), groups).select("group", *FEATURES)
    estimates = materialize(_start(grouped), "estimates")
    for _ in range(STEPS):
        estimates = materialize(_concentrate(grouped, estimates), "estimates")
    near = _with(grouped, estimates).where(F.col("distance") <= REWEIGHT * CONSISTENCY)
    final = materialize(_estimate(near.groupBy("group").agg(*_sums()), "group"), "estimates")
    judged = _in_group(counted, groups).join(final, "group", "left").withColumn("distance", _distance())
    distance = F.when(~F.col("failed"), F.col("distance"))
    return judged.select(
        "row",
        *COUNTS,
        F.col("failed").alias("base_failed"),
        distance.alias("distance"),
        (~F.col("failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"),
    )


def _in_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    return rows.join(groups, same).drop("of_lang", "of_source")


def _start(grouped: DataFrame) -> DataFrame:
    """Medians as the centre, quartile ranges as the spread, no covariance."""
    quartiles = grouped.groupBy("group").agg(
        *(F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q_{x}") for x in FEATURES)
    )
    spread = {x: (F.col(f"q_{x}")[2] - F.col(f"q_{x}")[0]) / 1.349 for x in FEATURES}
    return quartiles.select(
        "group",
        *(F.col(f"q_{x}")[1].alias(f"m_{x}") for x in FEATURES),
        *((spread[x] * spread[x] + FLOORS[x] ** 2).alias(f"d_{x}") for x in FEATURES),
        *(F.lit(0.0).alias(f"l_{z}{x}") for j, x in enumerate(FEATURES) for z in FEATURES[j + 1 :]),
    )


def _concentrate(grouped: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: the estimate of the bins of distance that hold the nearest share of each group."""
    place = F.floor(F.log2(F.col("distance") + 1) * _BINS)
    binned = (
        _with(grouped, estimates)
        .withColumn("bin", F.least(place, F.lit(_LAST_BIN)))
        .groupBy("group", "bin")
        .agg(*_sums())
    )
    upto = Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy("group")
    nearest = binned.select(
        "*",
        F.coalesce(F.sum("n").over(upto), F.lit(0.0)).alias("before"),
        F.sum("n").over(all_rows).alias("all"),
    ).where(F.col("before") < F.ceil(F.col("all") * KEPT_SHARE))
    sums = nearest.groupBy("group").agg(*(F.sum(name).alias(name) for name in _SUMS))
    return _estimate(sums, "group")
