"""Operator 1: quality statistics, and robust outliers by minimum covariance determinant.

Each text gives counts (words, characters, symbols, repeated lines and passages) and, from them, a vector of four
transformed statistics. For every language and source the centre and covariance come from the three quarters of rows
that lie closest together: concentration steps start at medians and median deviations, take the rows with the smallest
Mahalanobis distances, and estimate anew. A last step reweights by the 97.5 % point. Rows beyond `cutoff` are rejected.

Everything is DataFrame functions. Quantiles of distances come from histograms whose bins have a fixed relative width,
so a group of any size reaches the shuffle as a few hundred counts a task; moments are sums with a map-side part.

Defined results: null or empty text has no words and fails the base rule; rows that fail it take no part in the
estimates; a language and source with fewer than `least_rows` such rows is judged by its language, or by all rows where
that has too few; null languages and sources are groups of their own; below `least_rows` in all, nothing is rejected by
distance; repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, settle, words, workspace

WINDOW = 8
Z = ("z1", "z2", "z3", "z4")
#: Least standard deviation of each statistic: differences below say nothing about quality.
FLOORS = (0.03, 0.25, 0.3, 0.2)
CLOSE = 0.75  # share of rows that make the estimate
# Fixed values of the chi-square distribution with 4 degrees of freedom: consistency factors of the covariance of the
# closest 75 % and 97.5 %, and the 97.5 % point.
CLOSE_FACTOR, REWEIGHT_FACTOR, REWEIGHT = 1.49, 1.065, 11.14
CUTOFF = 30.0  # about five clean rows in a million lie beyond
LEVELS = ("all", "lang", "source")


# ---- statistics ----------------------------------------------------------------------------------------------------

def repeated_words(said: Column) -> Column:
    """Words inside windows of eight that occur twice or more in the text."""

    def covered(marks: Column) -> Column:
        order = F.sort_array(F.transform(marks, lambda m, i: F.struct(m.alias("m"), i.alias("i"))))

        def places(s: Column) -> Column:
            flagged = F.transform(s, lambda x, j: F.struct(
                x["i"].alias("i"), (F.get(s, j - 1)["m"].eqNullSafe(x["m"]) | F.get(s, j + 1)["m"].eqNullSafe(x["m"]))
                .alias("twice")))
            return F.sort_array(F.transform(F.filter(flagged, lambda x: x["twice"]), lambda x: x["i"]))

        def union(p: Column) -> Column:
            spans = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.get(p, j + 1) - x))
            return F.aggregate(spans, F.lit(0).cast("long"), lambda a, b: a + b)

        return let(let(order, places), union)

    starts = F.when(F.size(said) >= WINDOW, F.sequence(F.lit(1), F.size(said) - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>"))
    marks = F.transform(starts, lambda i: F.xxhash64(F.slice(said, i, WINDOW)))
    return let(marks, lambda m: F.when(F.size(F.array_distinct(m)) == F.size(m), F.lit(0).cast("long"))
               .otherwise(covered(m)))


def statistics(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and the statistic vector of every row; with `whole`, also `row`."""
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    counted = docs.select("doc_id", "lang", "source", *row, by_word.alias("w"), by_line.alias("l"),
                          F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    rows = counted.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines",
                          "w.n_repeat_words", "l.n_lines", *(["row"] if whole else []))
    some = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        "*", ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        # Word length, with a hundred words of five letters added so that short texts vary no more than long ones.
        F.log((F.col("word_chars") + 500) / (F.col("n_words") + 100)).alias("z1"),
        F.log(0.02 + F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))).alias("z2"),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("z3"),
        F.sqrt(F.col("n_repeat_words") / some).alias("z4"))


# ---- estimates -----------------------------------------------------------------------------------------------------

KEY = ["level", "k_lang", "k_source"]


def levels(rows: DataFrame) -> DataFrame:
    """Every row once for all rows, once for its language, once for its language and source."""
    none = F.lit(None).cast("string")
    keys = [(0, none, none), (1, F.col("lang"), none), (2, F.col("lang"), F.col("source"))]
    at = F.explode(F.array(*(F.struct(F.lit(n).alias("level"), a.alias("k_lang"), b.alias("k_source"))
                             for n, a, b in keys))).alias("at")
    return rows.filter("not base_failed").select(at, *Z).select("at.*", *Z)


def with_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """left joined to the row of `right` with the same key, null being equal to null."""
    other = right.select(*(F.col(k).alias(f"_{k}") for k in KEY), *(c for c in right.columns if c not in KEY))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY))
    return left.join(other, same).drop(*(f"_{k}" for k in KEY))


def quantile(rows: DataFrame, keys: list[str], value: Column, share: float, width: float, name: str) -> DataFrame:
    """Per key the upper edge of the bin in which `share` of the values is reached."""
    counts = rows.groupBy(*keys, F.floor(value / width).alias("bin")).agg(F.count("*").alias("n"))
    over = ", ".join(keys)
    reached = counts.withColumn("upto", F.expr(f"sum(n) over (partition by {over} order by bin)")).withColumn(
        "total", F.expr(f"sum(n) over (partition by {over})"))
    return reached.filter(F.col("upto") >= share * F.col("total")).groupBy(*keys).agg(
        ((F.min("bin") + 1) * width).alias(name))


def spread(rows: DataFrame) -> DataFrame:
    """Centre and Cholesky factor from medians and median deviations, no statistic depending on another."""
    each = rows.select(*KEY, F.posexplode(F.array(*Z)).alias("i", "z"))
    middle = quantile(each, [*KEY, "i"], F.col("z"), 0.5, 0.001, "m")
    other = middle.select(*(F.col(k).alias(f"_{k}") for k in [*KEY, "i"]), "m")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*KEY, "i"]))
    off = each.join(other, same).select(*KEY, "i", "m", F.abs(F.col("z") - F.col("m")).alias("off"))
    wide = quantile(off, [*KEY, "i", "m"], F.col("off"), 0.5, 0.001, "s")
    pick = [F.max(F.when(F.col("i") == n, F.col("m"))).alias(f"m{n + 1}") for n in range(4)]
    size = [F.max(F.when(F.col("i") == n, F.greatest(1.4826 * F.col("s"), F.lit(FLOORS[n])))).alias(f"l{n + 1}{n + 1}")
            for n in range(4)]
    off_diagonal = [F.lit(0.0).alias(f"l{a}{b}") for a in range(2, 5) for b in range(1, a)]
    return wide.groupBy(*KEY).agg(*pick, *size).select(*KEY, *(f"m{n}" for n in range(1, 5)),
                                                       *(f"l{n}{n}" for n in range(1, 5)), *off_diagonal)


def distance() -> Column:
    """Squared Mahalanobis distance from m1..m4 under the Cholesky factor l11..l44, by forward substitution."""
    y: list[Column] = []
    for a in range(1, 5):
        left = F.col(f"z{a}") - F.col(f"m{a}")
        for b in range(1, a):
            left = left - F.col(f"l{a}{b}") * y[b - 1]
        y.append(left / F.col(f"l{a}{a}"))
    return reduce(lambda a, b: a + b, (v * v for v in y))


def factor(rows: DataFrame, scale: float) -> DataFrame:
    """Centre and Cholesky factor of the covariance, scaled, with the floors added to its diagonal."""
    sums = [F.avg(f"z{a}").alias(f"m{a}") for a in range(1, 5)]
    sums += [F.covar_pop(f"z{a}", f"z{b}").alias(f"c{a}{b}") for a in range(1, 5) for b in range(1, a + 1)]
    out = rows.groupBy(*KEY).agg(F.count("*").alias("close"), *sums)
    for a in range(1, 5):
        for b in range(1, a + 1):
            value = F.col(f"c{a}{b}") * scale
            for k in range(1, b):
                value = value - F.col(f"l{a}{k}") * F.col(f"l{b}{k}")
            if a == b:
                # The floor also keeps the root real where rounding has made the rest negative.
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + FLOORS[a - 1] ** 2)
            else:
                value = value / F.col(f"l{b}{b}")
            out = out.withColumn(f"l{a}{b}", value)
    return out.drop(*(f"c{a}{b}" for a in range(1, 5) for b in range(1, a + 1)), "close")


def estimates(rows: DataFrame, folder: str, steps: int = 4) -> DataFrame:
    """Per key: rows, centre and Cholesky factor of the reweighted minimum-covariance-determinant estimate."""
    keyed = levels(rows)
    now = settle(spread(keyed), folder, "estimate-0")
    for n in range(1, steps + 1):
        far = with_key(keyed, now).select(*KEY, *Z, F.log(distance() + 1e-9).alias("far"))
        edge = quantile(far, KEY, F.col("far"), CLOSE, 1 / 64, "edge")
        close = with_key(far, edge).filter("far < edge")
        now = settle(factor(close, CLOSE_FACTOR), folder, f"estimate-{n}")
    near = with_key(keyed, now).filter(distance() <= REWEIGHT).select(*KEY, *Z)
    sizes = keyed.groupBy(*KEY).agg(F.count("*").alias("rows"))
    return settle(with_key(factor(near, REWEIGHT_FACTOR), sizes), folder, "estimate")


def judged(rows: DataFrame, found: DataFrame, cutoff: float, least_rows: int) -> DataFrame:
    """rows with distance (null where nothing could be estimated) and kept."""
    enough = found.filter(F.col("rows") >= least_rows)
    fields = [*(f"m{n}" for n in range(1, 5)), *(f"l{a}{b}" for a in range(1, 5) for b in range(1, a + 1))]
    everywhere = enough.filter("level = 0").select(*fields).first()  # one row of fourteen numbers, or none
    out = rows.withColumn("e0", F.struct(*(F.lit(everywhere[f] if everywhere else None).cast("double").alias(f)
                                           for f in fields)))
    for n in (1, 2):
        part = enough.filter(F.col("level") == n).select(F.col("k_lang").alias(f"_lang{n}"),
                                                         F.col("k_source").alias(f"_source{n}"),
                                                         F.struct(*fields).alias(f"e{n}"))
        same = F.col("lang").eqNullSafe(F.col(f"_lang{n}"))
        if n == 2:
            same = same & F.col("source").eqNullSafe(F.col(f"_source{n}"))
        out = out.join(part, same, "left")
    chosen = out.withColumn("e", F.coalesce("e2", "e1", "e0")).select(*rows.columns, "e.*")
    far = chosen.withColumn("distance", distance())
    return far.withColumn("kept", ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= cutoff)))


def judge(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = 50) -> DataFrame:
    """Every row's counts, base_failed, distance and kept; docs: doc_id, text, lang, source."""
    folder = workspace(docs.sparkSession)
    rows = settle(statistics(docs), folder, "statistics")
    return judged(rows, estimates(rows, folder), cutoff, least_rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance", "lang", "source")


def keep_good(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = 50) -> DataFrame:
    """The documents less the rejected ones.

    Statistics are worked out once for the estimates and once more beside the row they judge: that costs less than
    to bring verdicts and texts together by a shuffle of all texts.
    """
    folder = workspace(docs.sparkSession)
    found = estimates(settle(statistics(docs), folder, "statistics"), folder)
    return judged(statistics(docs, whole=True), found, cutoff, least_rows).filter("kept").select("row.*")
