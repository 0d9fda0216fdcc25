"""Quality rules: base limits, then robust multivariate outliers by language
and source.

Each text gives a vector of four transformed statistics: log of the mean word
length and log(1 + 100 x) of the shares of symbols, repeated lines and repeated
words. Per (language, source) the minimum covariance determinant estimate is
found by concentration steps: from a start, distances rank the group's texts,
the ``SHARE`` of them that is nearest gives the next mean and covariance, and so
on; of two starts (coordinate medians, and all texts' mean and covariance) the
one with the smaller determinant counts. A text is rejected if its Mahalanobis
distance passes the chi-square quantile ``LEVEL``.

One step is one aggregation: moments by (group, start, distance bin), summed up
along the bins until the share is reached. Rows are pre-aggregated before the
shuffle, so a source with a third of all texts costs no more than others, and no
group is ever gathered. The bins are fine (1/64 of a natural logarithm of
1 + squared distance); the share is rounded up to a whole bin.

``FLOORS`` are standard deviations below which a statistic is not told apart;
their squares are added to the diagonal, so a statistic that is constant in a
group (most have no symbols) leaves the covariance regular, and groups of any
size have an estimate (in a group of one text it is that text). They only
regularise: each is so small a part of its statistic's range that every statistic
alone can pass the cut among texts that are all alike.

Three-word windows are compared by a 64-bit hash of their words, within one text.

Defined cases: NULL and empty texts have no words and fail the base rule; NULL
language or source is a group of its own; repeated rows are judged each, with
the same verdict; an empty table gives no rows; other columns are ignored by
``judged`` and carried along by ``kept_documents``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import SPACES, let, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50            # base rule: least words, most per cent of repeated words
SHARE, LEVEL, STEPS, BIN = 0.75, 0.9999, 6, 64
FLOORS = (0.08, 0.30, 0.40, 0.40)
P = len(FLOORS)
X = [f"x{i}" for i in range(P)]
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]
GROUP = ["lang", "source"]


def chi2_below(x: float, dof: int) -> float:
    """P(chi-square <= x) for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(dof // 2):
        total += term
        term *= (x / 2) / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, dof: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_below(mid, dof) < p else (lo, mid)
    return lo


CUT = chi2_quantile(LEVEL, P)
# covariance of the nearest SHARE of a normal sample, made consistent
FACTOR = SHARE / chi2_below(chi2_quantile(SHARE, P), P + 2)


# ---------------------------------------------------------------- statistics

def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more."""
    def positions(hashes):      # of windows whose hash has an equal neighbour in hash order
        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), lambda s:
                   F.sort_array(F.transform(F.filter(s, lambda x, k:
                       F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                       | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))

    def covered(at):            # each window adds the words that the window before did not cover
        return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, p:
                           F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                           lambda a: a["n"])

    hashes = let(words, lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(covered(positions(h))))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(some)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                                         F.size(x).cast("long").alias("lines")))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base statistics and the vector x0..x3. All of it is built-in
    expressions inside the scan's stage."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = (docs.withColumn("_words", words_of(t)).withColumn("_lines", duplicate_lines(t))
           .withColumn("n_words", F.size("_words").cast("long"))
           .withColumn("word_chars", F.length(F.translate(t, SPACES, "")).cast("long"))
           .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
           .withColumn("n_dup_lines", F.col("_lines.dup"))
           .withColumn("n_repeat_words", repeated_words(F.col("_words")))
           .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))))

    def share(a, b):
        return F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))

    return (out.withColumn("x0", F.log(F.greatest(F.col("word_chars"), F.lit(1))
                                       / F.greatest(F.col("n_words"), F.lit(1))))
            .withColumn("x1", share("n_symbols", "word_chars"))
            .withColumn("x2", share("n_dup_lines", "_lines.lines"))
            .withColumn("x3", share("n_repeat_words", "n_words")).drop("_words", "_lines"))


# ---------------------------------------------------------------- the estimate

def with_factor(params: DataFrame, consistency: float) -> DataFrame:
    """Add the Cholesky factor l_ij of consistency * cov + floors^2 and
    ``logdet`` of it."""
    def entry(i, j):
        c = F.col(f"c{i}{j}") * consistency + (FLOORS[i] ** 2 if i == j else 0.0)
        for k in range(j):
            c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        return F.sqrt(c) if i == j else c / F.col(f"l{j}{j}")

    out = params
    for j in range(P):
        for i in range(j, P):
            out = out.withColumn(f"l{i}{j}", entry(i, j))
    return out.withColumn("logdet", sum((F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0)))


PARAMS = ["logdet", *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in _LOWER]]


def distance() -> Column:
    """Squared Mahalanobis distance of x from m, by forward substitution."""
    z = []
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def moments(bins: DataFrame, by: list[str]) -> DataFrame:
    """(by, m_i, c_ij) from sums n, s_i, s_ij."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(P)]
    return bins.select(*by, *[mean[i].alias(f"m{i}") for i in range(P)],
                       *[F.greatest(F.col(f"s{i}{j}") / F.col("n") - mean[i] * mean[j], F.lit(0.0)).alias(f"c{i}{j}")
                         if i == j else (F.col(f"s{i}{j}") / F.col("n") - mean[i] * mean[j]).alias(f"c{i}{j}")
                         for i, j in _LOWER])


def sums(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _LOWER])


def medians(rows: DataFrame) -> DataFrame:
    """Coordinate medians by group, to an eighth of a floor, with the floors
    as the only spread: the first start."""
    long = rows.select(*GROUP, F.posexplode(F.array(*[F.floor(F.col(f"x{i}") / (FLOORS[i] / 8))
                                                      for i in range(P)])).alias("dim", "bin"))
    run = Window.partitionBy(*GROUP, "dim").orderBy("bin")
    whole = Window.partitionBy(*GROUP, "dim")
    at = (long.groupBy(*GROUP, "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
          .withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(whole))
          .where("2 * upto >= all").groupBy(*GROUP, "dim").agg(F.min("bin").alias("bin")))
    return at.groupBy(*GROUP).agg(*[
        F.max(F.when(F.col("dim") == i, (F.col("bin") + 0.5) * (FLOORS[i] / 8))).alias(f"m{i}") for i in range(P)],
        *[F.lit(0.0).alias(f"c{i}{j}") for i, j in _LOWER])


def estimates(rows: DataFrame) -> DataFrame:
    """A row per group of ``rows`` (lang, source, x0..x3; written): the mean
    and the factor of its minimum covariance determinant estimate."""
    by = [*GROUP, "start"]
    start = medians(rows).withColumn("start", F.lit(0)).unionByName(
        moments(sums(rows, GROUP), GROUP).withColumn("start", F.lit(1)))
    params = written(with_factor(start, 1.0).select(*by, *PARAMS), "quality-start")
    for _ in range(STEPS):
        near = joined(rows, params).withColumn("bin", F.floor(F.log1p(distance()) * BIN))
        upto = Window.partitionBy(*by).orderBy("bin")
        cells = sums(near, [*by, "bin"])
        names = [c for c in cells.columns if c not in (*by, "bin")]
        run = cells.select(*by, "bin", *[F.sum(c).over(upto).alias(c) for c in names],
                           F.sum("n").over(Window.partitionBy(*by)).alias("all"))
        reached = run.where(F.col("n") >= SHARE * F.col("all")).groupBy(*by).agg(
            F.min_by(F.struct(*names), "bin").alias("s")).select(*by, "s.*")
        params = written(with_factor(moments(reached, by), FACTOR).select(*by, *PARAMS), "quality-step")
    return written(params.groupBy(*GROUP).agg(F.min_by(F.struct(*PARAMS), F.struct("logdet", "start")).alias("p"))
                   .select(*GROUP, "p.*"), "quality-estimates")


def joined(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with their groups' parameters; the table of groups is written, so
    its size decides how it is joined."""
    p = params.select(*[F.col(g).alias(f"_{g}") for g in GROUP], *[c for c in params.columns if c not in GROUP])
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(p, on, "left").drop("_lang", "_source")


def verdict() -> Column:
    """One expression over both sides of the join, not a conjunction: a filter
    on it stays above the statistics, which below it would be computed twice."""
    return F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(distance() <= CUT, F.lit(False)))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame) -> DataFrame:
    """The contract's columns, a row for each document. The estimates are made
    from the documents that pass the base rule."""
    rows = written(with_statistics(docs.select("doc_id", "text", *GROUP)).drop("text"), "quality-statistics")
    return (joined(rows, estimates(rows.where("not base_failed").select(*GROUP, *X)))
            .select("doc_id", *COUNTS, "base_failed", verdict().alias("kept")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged. Every row is written once
    with its statistics beside it; the estimates read the statistics alone and the
    verdict filters the written rows: nothing is computed twice and no text is shuffled."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text", *GROUP)
    rows = written(with_statistics(own).select("_row", *GROUP, *X, "base_failed"), "quality-statistics",
                   compression="zstd")
    return joined(rows, estimates(rows.where("not base_failed").select(*GROUP, *X))).where(verdict()).select("_row.*")
