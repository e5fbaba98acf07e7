"""Quality rules: base text statistics and robust multivariate outliers.

DataFrame functions only.  Base statistics of every whole text feed two
verdicts: fixed base limits, and a Mahalanobis distance of the transformed
statistic vector under a minimum-covariance-determinant estimate of the
document's language and source.

The estimate is searched from several deterministic starts (:func:`_starts`): the
classical mean and covariance, and medians with their absolute deviations, the
latter also with half of the rows as its first core, so rows that move the classical
estimate cannot hide there.  A concentration step takes a group's closest ``core``
share of rows as the next core; all starts of all groups step together until no
start's determinant falls, and the smallest determinant is kept.  A step is one
aggregation by (group, start, distance bin) with map-side combine, so a group with a
third of all rows is at most a few hundred rows per task after it.  Vectors are whole
numbers and sums are exact, so the result does not depend on the order of rows.

A core's covariance is scaled to be consistent for normal rows, so distances follow a
chi-squared law.  A statistic measured on few words, characters or lines varies by
itself: the variance of a log mean (coefficient of variation one half) and of a root
share are both 1/(4n), and each document's distance allows for its own.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import sized_broadcast
from .common import WHITESPACE, frozen, text_of

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Vector entries are stored as whole multiples of 1/SCALE, their measuring variances of 1/SCALE^2.
SCALE = 1024
DIMS = 4
CORE = 0.75
#: Least fall of a log determinant that is worth another step.
FALL = 1e-3
#: Rows a group needs for its own estimate; a smaller one uses its language's, then all.
MIN_ROWS = 200
#: Share of regular rows that the cut-off would take for outliers if they were normal.
OUTLIERS = 1e-4
#: Distance bins per doubling of 1 + d^2.
BINS = 16

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text plus ``STATS`` and ``n_lines`` (lines with a word), long.

    Words are runs of characters other than ``BLANKS``.  A null text has none.
    ``n_repeat_words`` counts the words covered by 5-word windows that occur
    twice or more: window hashes tell texts without any repeat; in the others
    the windows themselves are sorted and compared, so the count is exact.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns
            if c not in (text_col, *STATS, "n_lines") and not c.startswith("__")]
    t = text_of(text_col)

    def without(chars: str, c: Column) -> Column:
        return F.length(F.translate(c, chars, ""))

    base = docs.select(
        *rest, t.alias("__t"),
        F.filter(F.split(t, WHITESPACE), lambda w: w != "").alias("__w"),
        F.filter(F.split(t, "\n", -1), lambda x: without(BLANKS, x) > 0).alias("__l"))
    n = F.size("__w")
    base = base.select(
        *rest, "__w", n.cast("bigint").alias("n_words"),
        without(BLANKS, F.col("__t")).cast("bigint").alias("word_chars"),
        (F.length("__t") - without(SYMBOLS, F.col("__t"))).cast("bigint").alias("n_symbols"),
        F.size("__l").cast("bigint").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    places = F.sequence(F.lit(0), n - WINDOW)
    none = F.array().cast("array<bigint>")
    base = base.withColumn("__win", F.when(n >= WINDOW, F.transform(places, lambda i: F.xxhash64(
        *[F.get("__h", i + k) for k in range(WINDOW)]))).otherwise(none))
    keyed = F.sort_array(F.transform(places, lambda i: F.struct(
        F.get("__win", i).alias("h"), F.slice("__w", i + 1, WINDOW).alias("w"), i.alias("i"))))
    empty = F.array().cast("array<struct<h:bigint,w:array<string>,i:int>>")
    repeats = F.size(F.array_distinct("__win")) < F.size("__win")
    base = base.withColumn("__s", F.when(repeats, keyed).otherwise(empty)).drop("__win", "__h", "__w")

    def twice(x: Column, k: Column) -> Column:
        other = [F.get("__s", k - 1), F.get("__s", k + 1)]
        return F.coalesce((other[0]["h"] == x["h"]) & (other[0]["w"] == x["w"]), F.lit(False)) | \
            F.coalesce((other[1]["h"] == x["h"]) & (other[1]["w"] == x["w"]), F.lit(False))

    starts = F.array_sort(F.transform(F.filter("__s", twice), lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).alias("c")),
        lambda a, p: F.struct(p.alias("p"), (a["c"] + F.least(F.lit(WINDOW), p - a["p"])).alias("c")),
        lambda a: a["c"])
    return base.withColumn("n_repeat_words", covered.cast("bigint")).drop("__s")


def base_failed() -> Column:
    """Too few words, or more than the allowed share in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _counts() -> list[Column]:
    """What each vector entry is measured on: words, characters, lines, windows of repeated words."""
    return [F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines")] + [
        F.greatest(F.col("n_words") / WINDOW, F.lit(1.0))]


def _vector() -> list[Column]:
    """Transformed statistics ``__x*``: log mean word length, root shares of symbols,
    duplicate lines and repeated words, and their measuring variances ``__e*``; whole numbers."""
    words, chars, lines, _ = _counts()
    raw = [F.log(chars / words), F.sqrt(F.col("n_symbols") / chars),
           F.sqrt(F.col("n_dup_lines") / lines), F.sqrt(F.col("n_repeat_words") / words)]
    return [F.round(c * SCALE).cast("bigint").alias(f"__x{i}") for i, c in enumerate(raw)] + [
        F.ceil(SCALE ** 2 / (4 * n)).cast("bigint").alias(f"__e{i}") for i, n in enumerate(_counts())]


_XS = [f"__x{i}" for i in range(DIMS)]
_ES = [f"__e{i}" for i in range(DIMS)]
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
_GROUP = ["__lang", "__source"]


def chi_squared(x: float, half: int) -> float:
    """Distribution function of the chi-squared law with ``2 * half`` degrees of freedom."""
    terms = [1.0]
    for k in range(1, half):
        terms.append(terms[-1] * x / 2 / k)
    return 1 - math.exp(-x / 2) * sum(terms)


def quantile(p: float, half: int = DIMS // 2) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_squared(mid, half) < p else (lo, mid)
    return hi


def consistency(core: float) -> float:
    """Factor that makes the covariance of the closest ``core`` share of normal rows that of all."""
    return core / chi_squared(quantile(core), DIMS // 2 + 1)


#: Squared distance beyond which a vector is an outlier.
CUTOFF = quantile(1 - OUTLIERS)


def _sums() -> list[Column]:
    exact = "decimal(20,0)"
    return [F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(x).cast(exact)).alias(f"s{i}") for i, x in enumerate(_XS)],
            *[F.sum(F.col(e).cast(exact)).alias(f"f{i}") for i, e in enumerate(_ES)],
            *[F.sum((F.col(f"__x{i}") * F.col(f"__x{j}")).cast(exact)).alias(f"q{i}{j}")
              for i, j in _PAIRS]]


_SUMS = ["n", *[f"s{i}" for i in range(DIMS)], *[f"f{i}" for i in range(DIMS)], *[f"q{i}{j}" for i, j in _PAIRS]]


def _moments(sums: DataFrame, factor: float) -> DataFrame:
    """Mean ``m_i``, covariance ``v_ij`` times ``factor`` and mean measuring variance ``w_i`` of summed rows."""
    keep = [c for c in sums.columns if c not in _SUMS]
    mean = [F.col(f"s{i}").cast("double") / F.col("n") / SCALE for i in range(DIMS)]
    return sums.select(*keep, *[mean[i].alias(f"m{i}") for i in range(DIMS)], *[
        (F.col(f"f{i}").cast("double") / F.col("n") / SCALE ** 2).alias(f"w{i}") for i in range(DIMS)], *[
        (factor * (F.col(f"q{i}{j}").cast("double") / F.col("n") / SCALE ** 2 - mean[i] * mean[j])).alias(f"v{i}{j}")
        for i, j in _PAIRS])


def _factored(rows: DataFrame, variances: list[Column]) -> DataFrame:
    """Add the lower Cholesky factor ``c_ij`` of ``v_ij`` with ``variances`` on its diagonal and ``logdet``."""
    def rest(i: int, j: int) -> Column:
        cov = F.col(f"v{i}{j}") + (variances[i] if i == j else F.lit(0.0))
        for k in range(j):
            cov = cov - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
        return cov

    for j in range(DIMS):
        rows = rows.withColumn(f"c{j}{j}", F.sqrt(F.greatest(rest(j, j), variances[j] / 4)))
        below = {f"c{i}{j}": rest(i, j) / F.col(f"c{j}{j}") for i in range(j + 1, DIMS)}
        rows = rows.withColumns(below) if below else rows
    return rows.withColumn("logdet", 2 * sum((F.log(f"c{i}{i}") for i in range(DIMS)), F.lit(0.0)))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    total, z = F.lit(0.0), []
    for i in range(DIMS):
        v = F.col(f"__x{i}") / SCALE - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"c{i}{k}") * z[k]
        z.append(v / F.col(f"c{i}{i}"))
        total = total + z[i] * z[i]
    return total


def _joined(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    e = estimates.withColumnsRenamed({"lang": "__el", "source": "__es"})
    on = rows["__lang"].eqNullSafe(e["__el"]) & rows["__source"].eqNullSafe(e["__es"])
    return rows.join(sized_broadcast(e), on, "left").drop("__el", "__es")


def _middles(vectors: DataFrame) -> DataFrame:
    """Exact median ``m_i`` and squared scaled median absolute deviation ``d_i`` per group and entry, from
    a table of value counts (entries have few different values, however many rows there are)."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(_XS)]))
    counts = frozen(vectors.select(*_GROUP, cells.alias("c")).groupBy(*_GROUP, "c.i", "c.x").agg(
        F.count(F.lit(1)).alias("n")))
    key = [*_GROUP, "i"]

    def middle(table: DataFrame, value: str, out: str) -> DataFrame:
        upto = F.sum("n").over(Window.partitionBy(*key).orderBy(value))
        total = F.sum("n").over(Window.partitionBy(*key))
        return (table.withColumn("u", upto).withColumn("t", total).where(2 * F.col("u") >= F.col("t"))
                .groupBy(*key).agg(F.min(value).alias(out)))

    centre = frozen(middle(counts, "x", "m"))
    spread = middle(counts.join(sized_broadcast(centre), key).withColumn("a", F.abs(F.col("x") - F.col("m"))), "a", "d")
    both = centre.join(sized_broadcast(spread), key)
    return both.groupBy(*_GROUP).agg(
        *[F.max(F.when(F.col("i") == i, F.col("m") / SCALE)).alias(f"m{i}") for i in range(DIMS)],
        *[F.max(F.when(F.col("i") == i, F.pow(1.4826 * F.col("d") / SCALE, 2.0))).alias(f"d{i}") for i in range(DIMS)])


def _starts(vectors: DataFrame, core: float) -> DataFrame:
    """First estimates ``(lang, source, size, start, share, m*, w*, v*)``; ``share``: rows of the first core."""
    classical = (_moments(vectors.groupBy(*_GROUP).agg(*_sums()).withColumn("size", F.col("n")), 1.0)
                 .withColumns({"start": F.lit(0), "share": F.lit(core)}))
    diagonal = [F.col(f"d{i}") if i == j else F.lit(0.0) for i, j in _PAIRS]
    robust = (classical.select(*_GROUP, "size", *[f"w{i}" for i in range(DIMS)])
              .join(sized_broadcast(frozen(_middles(vectors))), _GROUP)
              .select("*", *[v.alias(f"v{i}{j}") for v, (i, j) in zip(diagonal, _PAIRS)])
              .withColumn("s", F.explode(F.array(F.struct(F.lit(1).alias("start"), F.lit(core).alias("share")),
                                                 F.struct(F.lit(2).alias("start"), F.lit(0.5).alias("share")))))
              .withColumns({"start": F.col("s.start"), "share": F.col("s.share")}))
    return (classical.unionByName(robust.select(*classical.columns))
            .withColumnsRenamed({"__lang": "lang", "__source": "source"}))


def robust_estimates(vectors: DataFrame, core: float = CORE) -> DataFrame:
    """Minimum-determinant estimate per ``(lang, source)`` of ``vectors`` (``__lang, __source, __x*, __e*``) with
    the group's ``size``; one aggregation and one small written table per step."""
    mean_error = [F.col(f"w{i}") for i in range(DIMS)]
    now = frozen(_factored(_starts(vectors, core), mean_error).withColumn("best", F.lit(float("inf"))))
    found = []
    while True:
        binned = _joined(vectors, now.select("lang", "source", "size", "start", "share", "best",
                                             *[f"m{i}" for i in range(DIMS)], *[f"c{i}{j}" for i, j in _PAIRS]))
        binned = binned.withColumn("bin", F.floor(F.log2(1 + _distance()) * BINS).cast("int"))
        run = [*_GROUP, "size", "start", "share", "best"]
        per_bin = binned.groupBy(*run, "bin").agg(*_sums())
        below = Window.partitionBy(*run).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        inner = (per_bin.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
                 .where(F.col("before") < F.col("share") * F.col("size")))
        sums = (inner.groupBy(*run).agg(*[F.sum(c).alias(c) for c in _SUMS])
                .withColumnsRenamed({"__lang": "lang", "__source": "source"}))
        # a first core of another share is no candidate: determinants of smaller cores are smaller
        whole = F.col("share") == core
        stepped = _factored(_moments(sums, 1.0), mean_error).withColumn(
            "fell", F.when(whole, F.coalesce(F.col("best") - F.col("logdet"), F.lit(0.0))).otherwise(1.0))
        now = frozen(stepped.withColumn("best", F.when(whole, F.least("best", "logdet")).otherwise(F.col("best")))
                     .withColumn("candidate", whole).withColumn("share", F.lit(core)))
        found.append(now.where("candidate"))
        if not (now.agg(F.max("fell")).first()[0] or 0) > FALL:
            break
    every = functools.reduce(DataFrame.unionByName, found)
    least = Window.partitionBy("lang", "source").orderBy("logdet", "start")
    kept = every.withColumn("r", F.row_number().over(least)).where("r = 1")
    names = ["lang", "source", "size", *[f"m{i}" for i in range(DIMS)]]
    return kept.select(*names, *[(consistency(core) * F.col(f"v{i}{j}")).alias(f"v{i}{j}") for i, j in _PAIRS])


def learned_estimates(stats: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Estimates of the groups of ``min_rows`` rows and more among ``stats`` (with
    ``base_failed``), of each language and of all, under keys of level 0, 1 and 2."""
    passed = stats.where(~F.col("base_failed")).select("lang", "source", *_vector())
    cells = [*_XS, *_ES]
    levels = F.explode(F.array(*[F.struct(_key(k, "lang").alias("lang"), _key(k, "source").alias("source"))
                                 for k in range(3)]))
    tagged = frozen(passed.select(levels.alias("__g"), *cells).select(
        F.col("__g.lang").alias("__lang"), F.col("__g.source").alias("__source"), *cells))
    return frozen(robust_estimates(tagged).where((F.col("size") >= min_rows) | F.col("lang").startswith("2:")))


def _key(level: int, column: str) -> Column:
    own = F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("-"))
    if column == "source":
        return own if level == 0 else F.lit("-")
    return F.concat(F.lit(f"{level}:"), own if level < 2 else F.lit("-"))


def judged(stats: DataFrame, estimates: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` plus ``distance`` (squared; null for a failed document) and ``kept``, by the
    estimate of the document's group, else its language's, else that of all."""
    out = stats.select("*", *_vector())
    own_error = [F.col(e) / SCALE ** 2 for e in _ES]
    cells = [*[f"m{i}" for i in range(DIMS)], *[f"v{i}{j}" for i, j in _PAIRS]]
    for level in range(3):
        keyed = out.withColumns({"__lang": _key(level, "lang"), "__source": _key(level, "source")})
        own = estimates.where(F.col("lang").startswith(f"{level}:")).select(
            "lang", "source", F.struct(*cells).alias(f"__g{level}"))
        out = _joined(keyed, own).drop(*_GROUP)
    # the estimate is picked first, so one factor and one distance are computed and compiled, not three
    groups = [f"__g{level}" for level in range(3)]
    out = out.withColumn("__g", F.coalesce(*groups)).select("*", "__g.*").drop("__g", *groups)
    out = _factored(out, own_error).withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return (out.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(
                F.coalesce(F.col("distance") <= cutoff, F.lit(True))))
            .drop(*_XS, *_ES, "logdet", *cells, *[f"c{i}{j}" for i, j in _PAIRS]))


def _statistics(docs: DataFrame, text_col: str) -> DataFrame:
    docs = docs.drop("base_failed", "kept", "distance", "size")
    return text_statistics(docs, text_col).withColumn("base_failed", base_failed())


def quality_verdicts(docs: DataFrame, text_col: str = "text", min_rows: int = MIN_ROWS,
                     cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` without its text plus the statistics, ``base_failed``, ``distance`` and ``kept``.

    ``docs`` needs ``lang`` and ``source``; a null one is a value of its own.
    Only documents that pass the base limits shape the estimates.  Repeated rows
    stay; an empty frame gives an empty one; input columns named like the results
    are replaced.
    """
    stats = frozen(_statistics(docs, text_col))
    return judged(stats, learned_estimates(stats, min_rows), cutoff)


def kept_documents(docs: DataFrame, text_col: str = "text", min_rows: int = MIN_ROWS,
                   cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` keeps, unchanged.

    Statistics are measured once and written beside their rows; only they are read for the estimates.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    stats = frozen(_statistics(docs.select("lang", "source", text_col, whole), text_col))
    estimates = learned_estimates(stats.drop("row"), min_rows)
    return judged(stats, estimates, cutoff).where("kept").select("row.*")
