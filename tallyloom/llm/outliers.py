"""Quality rules and robust outliers with built-in functions only.

Statistics of each text form a vector. For each language and source the minimum-covariance-determinant estimate of centre
and scatter comes from the ``share`` of rows nearest to it: concentration steps start from medians and median deviations, and
again from means and covariances; each keeps the nearest rows of the last estimate, until no group's determinant falls any
more, and each group takes the estimate of its least determinant. Variances have a floor, so that a statistic that is
constant in most texts rejects no small deviation. Rows of great Mahalanobis distance are rejected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, fresh, stored

SPACES = r"[\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Settings:
    """``share``: part of the rows that the estimate keeps. ``steps``: concentration steps of a start at most. ``quantile``: of the
    chi-squared distribution, beyond which a row goes. ``least_rows``: smaller groups are pooled by language, then
    altogether, and judge nothing if still smaller. ``floors``: least standard deviations of the statistics, small
    against the range of those that are shares, so that each can reject a text alone."""

    share: float = 0.75
    steps: int = 12
    quantile: float = 0.999
    least_rows: int = 50
    floors: tuple[float, ...] = (0.5, 0.4, 0.06, 0.15, 0.11, 0.05, 0.05)
    bins_per_doubling: int = 16


def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of chi-squared with k degrees of freedom, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / math.gamma(k / 2 + 1)
    n = 0
    while term > 1e-17 * total:
        n += 1
        term *= x / 2 / (k / 2 + n)
        total += term
    return min(1.0, total * math.exp(-x / 2 + k / 2 * math.log(x / 2)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < p else (low, middle)
    return high


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with the counts of every whole text; null texts have none.

    Windows of three words are compared by a 64-bit hash: sorted with their places, equal ones lie side by side.
    """
    text, words, grams, ordered, places, lines = fresh(
        [*docs.columns, *COUNTS], "text_", "words_", "grams_", "ordered_", "places_", "lines_"
    )
    rest = [c for c in docs.columns if c != "text" and c not in COUNTS]
    step1 = docs.select(*rest, F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text))
    step2 = step1.select(
        *rest,
        F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias(words),
        F.length(F.regexp_replace(F.col(text), SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(F.col(text), r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(F.col(text), r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace(F.col(text), r"[^!?]+", "")).cast("long").alias("n_marks"),
        F.filter(F.split(F.col(text), "\n", -1), lambda x: F.rlike(x, F.lit(WORD))).alias(lines),
    )
    count = F.size(words)
    zipped = F.arrays_zip(
        F.col(words).alias("a"), F.slice(F.col(words), 2, F.greatest(count, F.lit(1))).alias("b"),
        F.slice(F.col(words), 3, F.greatest(count, F.lit(1))).alias("c"),
    )
    step3 = step2.withColumn("n_words", count.cast("long")).withColumn(
        grams,
        F.transform(
            F.slice(zipped, 1, F.greatest(count - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i")),
        ),
    )
    step4 = step3.withColumn(ordered, F.sort_array(grams))

    def is_repeated(x: Column, k: Column) -> Column:
        return (F.get(F.col(ordered), k - 1)["h"] == x["h"]) | (F.get(F.col(ordered), k + 1)["h"] == x["h"])

    step5 = step4.withColumn(
        places,
        F.sort_array(F.transform(F.filter(F.col(ordered), lambda x, k: F.coalesce(is_repeated(x, k), F.lit(False))), lambda x: x["i"])),
    )
    covered = F.aggregate(
        F.transform(F.col(places), lambda x, k: F.least(F.lit(3), F.coalesce(F.get(F.col(places), k + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )
    return step5.select(
        *rest,
        *COUNTS[:3],
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        "n_capitals",
        "n_marks",
    )


def vector() -> list[Column]:
    """The transformed statistics of a row of ``counted``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log(words.cast("double")),
        F.log(chars / words) * 2,
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
        F.sqrt(F.col("n_capitals") / chars),
        F.sqrt(F.col("n_marks") / words),
    ]


# Parts the rows of one group are dealt to where they meet what is known of their group.
PARTS = 32


def _with_group(rows: DataFrame, known: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``known``, one row for each group, repeated for each part of a group."""
    part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long")))
    return rows.withColumn("part_", part).join(known.withColumn("part_", every), ["group", "part_"], how).drop("part_")


def _keyed(kind: str, *columns: str) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]
    return F.concat_ws("\u0000", F.lit(kind), *parts)


def grouped(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` with ``group``: language and source if they have enough rows, else language, else all, else null."""
    for kind, columns in (("source", ["lang", "source"]), ("lang", ["lang"]), ("all", [])):
        key = _keyed(kind, *columns)
        rows = rows.withColumn("group", F.coalesce("group", key) if "group" in rows.columns else key)
        small = rows.groupBy("group").agg(F.count(F.lit(1)).alias("rows_")).where(F.col("rows_") < least).select("group")
        small = small.withColumn("small_", F.lit(True))
        rows = _with_group(rows, small, "left").withColumn("group", F.when(F.col("small_").isNull(), F.col("group"))).drop("small_")
    return rows


def _distance(rows: DataFrame, estimate: DataFrame, p: int, keep: list[str]) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` under its group's centre m and Cholesky factor l."""
    out = _with_group(rows, estimate)
    for i in range(p):
        inner = sum((F.col(f"l{i}_{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - inner) / F.col(f"l{i}_{i}"))
    return out.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(p)), F.lit(0.0))).select(*keep, "d2")


def _nearest(scored: DataFrame, settings: Settings) -> DataFrame:
    """Rows among the ``share`` of their group with the least distance, to a bin; bins are counted exactly."""
    binned = scored.withColumn(
        "bin", F.floor(F.log2(F.col("d2") + 1e-6) * settings.bins_per_doubling).cast("int")
    )
    counts = binned.groupBy("group", "bin").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy("group")
    upto = everything.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        .withColumn("every", F.sum("n").over(everything))
        .where(F.col("before") < F.col("every") * settings.share)
        .groupBy("group")
        .agg(F.max("bin").alias("cut"))
    )
    return _with_group(binned, cut).where(F.col("bin") <= F.col("cut"))


def _estimate(rows: DataFrame, p: int, floors: tuple[float, ...], scale: float) -> DataFrame:
    """Centre and Cholesky factor of the scatter of each group's rows."""
    sums = [F.avg(f"x{i}").alias(f"m{i}") for i in range(p)]
    sums += [F.covar_pop(f"x{i}", f"x{j}").alias(f"a{i}_{j}") for i in range(p) for j in range(i + 1)]
    out = stored(rows.groupBy("group").agg(*sums), "scatter")
    for j in range(p):
        for i in range(j, p):
            left = F.col(f"a{i}_{j}") * scale - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            if i == j:
                # at least the floor: the factor then always exists
                value = F.sqrt(F.greatest(left, F.lit(floors[i] ** 2)))
            else:
                value = left / F.col(f"l{j}_{j}")
            out = out.withColumn(f"l{i}_{j}", value)
    return out.select("group", *[f"m{i}" for i in range(p)], *[f"l{i}_{j}" for i in range(p) for j in range(i + 1)])


def _start(rows: DataFrame, p: int, floors: tuple[float, ...]) -> DataFrame:
    """Medians, and scatter from median deviations, as a first estimate."""
    centre = rows.groupBy("group").agg(*[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(p)])
    centre = stored(centre, "medians")
    off = _with_group(rows, centre)
    spread = off.groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 1000).alias(f"s{i}") for i in range(p)]
    )
    out = centre.join(spread, "group")
    for i in range(p):
        for j in range(i + 1):
            value = F.greatest(F.col(f"s{i}") * 1.4826, F.lit(floors[i])) if i == j else F.lit(0.0)
            out = out.withColumn(f"l{i}_{j}", value)
    return stored(out.drop(*[f"s{i}" for i in range(p)]), "start")


def _log_det(p: int) -> Column:
    """Logarithm of the determinant of an estimate's scatter."""
    return sum((2 * F.log(F.col(f"l{i}_{i}")) for i in range(p)), F.lit(0.0))


def _least(estimates: DataFrame) -> DataFrame:
    """Of each group's estimates the one with the least determinant."""
    found = estimates.groupBy("group").agg(F.min_by(F.struct(*estimates.columns), "log_det").alias("best"))
    return found.select("best.*")


def _concentrated(vectors: DataFrame, estimate: DataFrame, p: int, settings: Settings, scale: float) -> DataFrame:
    """Each group's estimate of least determinant among the concentration steps from ``estimate``, and its ``log_det``. Steps end
    when no group's determinant falls."""
    best = None
    for _ in range(settings.steps):
        kept = _nearest(_distance(vectors, estimate if best is None else best, p, vectors.columns), settings)
        # written out, as a filter on the determinant would otherwise repeat the factor's nested terms
        step = stored(_estimate(kept, p, settings.floors, scale).withColumn("log_det", _log_det(p)), "step")
        if best is None:
            best = step
            continue
        last = best.select("group", F.col("log_det").alias("least"))
        if step.join(last, "group").where("log_det < least - 1e-9").isEmpty():
            break
        best = stored(_least(best.unionByName(step)), "least")
    return best


def robust_distances(rows: DataFrame, p: int, settings: Settings) -> DataFrame:
    """``rows`` (group, x0 .. x(p-1) and others) with ``d2``, scaled so that normal rows follow chi-squared."""
    inner = chi2_quantile(settings.share, p)
    scale = settings.share / chi2_cdf(inner, p + 2)
    vectors = rows.select("group", *[f"x{i}" for i in range(p)])
    starts = [_start(vectors, p, settings.floors), stored(_estimate(vectors, p, settings.floors, 1.0), "start")]
    first, second = (_concentrated(vectors, start, p, settings, scale) for start in starts)
    estimate = _least(first.unionByName(second)).drop("log_det")
    return _distance(rows, stored(estimate, "estimate"), p, rows.columns)


def quality_rules(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The columns of ``docs`` but its text, with the counts, base_failed, distance and kept of every row.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word windows. Those rows are
    neither kept nor used for the estimates, and have no distance. Null languages and sources are groups of their own;
    null and empty texts fail. Rows of groups too small for an estimate are kept. Repeated rows count as often as they
    stand. Columns named like a result are replaced, others stay whatever their names. An empty table gives an empty result.
    """
    settings = settings or Settings()
    docs = docs.drop(*COUNTS, "base_failed", "distance", "kept")
    others = [c for c in docs.columns if c not in ("doc_id", "lang", "source", "text")]
    # names that no column of this module has
    apart = {c: f"column {k} of the documents" for k, c in enumerate(others)}
    found = _judged(docs.withColumnsRenamed(apart), settings)
    return found.withColumnsRenamed({b: a for a, b in apart.items()})


def _judged(docs: DataFrame, settings: Settings) -> DataFrame:
    p = len(settings.floors)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = counted(docs).withColumn("base_failed", failed)
    rows = stored(rows.withColumns({f"x{i}": x for i, x in enumerate(vector()[:p])}), "statistics")
    rest = [c for c in docs.columns if c != "text"]
    out = [*rest, *COUNTS, "base_failed"]
    passed = stored(grouped(rows.where("NOT base_failed"), settings.least_rows), "groups")
    scored = robust_distances(passed.where(F.col("group").isNotNull()), p, settings)
    cutoff = chi2_quantile(settings.quantile, p)
    none = F.lit(None).cast("double")
    return (
        scored.select(*out, F.col("d2").alias("distance"), (F.col("d2") <= cutoff).alias("kept"))
        .unionByName(passed.where(F.col("group").isNull()).select(*out, none.alias("distance"), F.lit(True).alias("kept")))
        .unionByName(rows.where("base_failed").select(*out, none.alias("distance"), F.lit(False).alias("kept")))
    )
