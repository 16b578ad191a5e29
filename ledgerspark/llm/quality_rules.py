"""Quality rules: base rules, and robust multivariate outliers, with DataFrame functions only.

The base rules fail texts of fewer than 50 words, and texts of which more than
half the words stand in repeated 3-word windows.  The others become vectors of
four transformed statistics: the log of the mean word length, and the square
roots of the shares of symbols, duplicate lines and repeated words.  For each
language and source the minimum-covariance-determinant estimate of centre and
scatter is found:

1. Four starts, each about the medians: the median deviations alone; with the
   correlations of the scaled vectors' hyperbolic tangents; with those of their
   spatial signs; and the vectors' mean and covariance.
2. From each, concentration steps: the ``share`` of the vectors that is nearest
   gives the next estimate.  A step's determinant is compared with the last one;
   a start goes on until it no longer falls (or all rounds are done).
3. The estimate with the least determinant of all is reweighted: all vectors
   that are near by it, scaled to be right for normal data, give the last one.

A text is rejected if its squared Mahalanobis distance exceeds ``cutoff``, the
0.999 quantile of chi-squared, which normal data exceed once in a thousand.
Each statistic's variance has its resolution added: the mean square of the step
that one symbol, one line or one word makes in the group's texts (for the word
length, the sampling error of a mean), so that where most texts have no symbol
or no repeated line, one of them is no outlier.

Vectors are integers (1/1024 units) and sums are integer sums, so results don't
depend on the order of rows.  Texts are read once; the vectors, a few numbers a
row, are written to the shared folder.  Equal vectors of a language and source
become one cell with their number, and the steps run over cells.  A step sums
each cell into a bin of its distance (1/256 of a power of two); bins up to the
share count whole, the last one in part.  So a step deals rows by group, start
and bin, never by group alone, and what one task sees of a group is bounded by
the number of bins, also for a source of a third of all rows.

Languages and sources of fewer than ``least`` vectors are taken together by
language, and if still too small all together; if even these are too few, they
are judged by the estimate over all vectors.  Only in a table of fewer vectors
nothing is rejected among them.

Defined cases: a missing text has no words and fails; a missing language or
source is a value of its own; texts that repeat are judged alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_JAVA, written

UNIT = 1024
#: Quantiles of chi-squared with 4 degrees of freedom at 0.75, 0.975 and 0.999.
CHI_75, CHI_975, CHI_999 = 5.385, 11.143, 18.467
BINS = 256
STARTS = 4
HOLD = 20000
SALT = 16
#: What the scatter of normal data within CHI_975 is short of: 0.975 / P(chi-squared with 6 degrees <= CHI_975).
CONSISTENT = 0.975 / 0.91594
DIMENSIONS = 4


def base_statistics(docs: DataFrame, with_doc: bool = False) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines for docs (doc_id, text, lang, source); doc, the whole row, if asked for."""
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if with_doc else []
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.regexp_extract_all(text, F.lit(f"({WORD_JAVA})")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"), *doc,
    )
    rows = rows.select(
        "doc_id", "lang", "source", "n_symbols", *(["doc"] if with_doc else []), F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("slice(transform(words, (w, i) -> concat_ws(' ', w, get(words, i + 1), get(words, i + 2))), 1, greatest(size(words) - 2, 0))").alias("windows"),
    )
    # sorted with their places only where a window is there twice
    rows = rows.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("w"), i.alias("i"))))))
    again = "filter(windows, (x, k) -> x.w = get(windows, k - 1).w OR x.w = get(windows, k + 1).w)"
    rows = rows.withColumn("windows", F.expr(again))
    covered = "size(array_distinct(flatten(transform(windows, x -> array(x.i, x.i + 1, x.i + 2)))))"
    return rows.withColumn("n_repeat_words", F.coalesce(F.when(F.col("windows").isNotNull(), F.expr(covered)), F.lit(0)).cast("long")).drop("windows")


def vector() -> list[Column]:
    """The transformed statistics, in units of 1 / UNIT."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    values = (F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"))
    return [F.round(v * UNIT).cast("long").alias(f"z{i}") for i, v in enumerate(values)]


def resolution() -> list[Column]:
    """Each statistic's squared resolution in a text, in units of 1 / UNIT squared."""
    counts = (4 * F.col("n_words"), F.col("word_chars"), F.col("n_lines"), F.col("n_words"))
    return [F.round(F.lit(UNIT**2) / F.greatest(n, F.lit(1))).cast("long").alias(f"r{i}") for i, n in enumerate(counts)]


D = range(DIMENSIONS)
PAIRS = [(i, j) for i in D for j in range(i + 1)]
Z, R = [f"z{i}" for i in D], [f"r{i}" for i in D]
ESTIMATE = [*[f"m{i}" for i in D], *[f"l{i}{j}" for i, j in PAIRS]]


def _hold(table: DataFrame, most: int = HOLD):
    """How to join with a table, and others of no more rows: broadcast if a count shows that it is small."""
    return F.broadcast if table.limit(most + 1).count() <= most else (lambda x: x)


def _moments(values: list[Column], name: str) -> list[Column]:
    """Integer sums of values and of their products, each cell as often as w says."""
    return [F.sum(v * F.col("w")).alias(f"{name}{i}") for i, v in enumerate(values)] + [F.sum(values[i] * values[j] * F.col("w")).alias(f"{name}{i}{j}") for i, j in PAIRS]


def _covariance(name: str, i: int, j: int, n: Column) -> Column:
    return F.col(f"{name}{i}{j}") / n - (F.col(f"{name}{i}") / n) * (F.col(f"{name}{j}") / n)


#: What goes along with an estimate from step to step: the number of vectors and the resolutions.
ALONG = ["n", *[f"floor{i}" for i in D]]


def _root(rows: DataFrame, *keep: str) -> DataFrame:
    """Cholesky: c = l l', column by column, as expressions; and the log of the determinant of l."""
    for j in D:
        own = F.col(f"c{j}{j}") - reduce(lambda a, b: a + b, [F.col(f"l{j}{k}") ** 2 for k in range(j)], F.lit(0.0))
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(own, F.lit(1e-3))))
        for i in range(j + 1, DIMENSIONS):
            rest = F.col(f"c{i}{j}") - reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
            rows = rows.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    return rows.select(*keep, *ESTIMATE, reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in D]).alias("logdet"))


def distance(rows: DataFrame) -> DataFrame:
    """rows (z0.., m0.., l00..) with d2, the squared Mahalanobis distance."""
    names = []
    for i in D:
        inner = reduce(lambda a, b: a - b, [F.col(f"l{i}{k}") * F.col(names[k]) for k in range(i)], F.col(f"z{i}") - F.col(f"m{i}"))
        names.append(f"y{i}")
        rows = rows.withColumn(f"y{i}", inner / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", reduce(lambda a, b: a + b, [F.col(y) ** 2 for y in names])).drop(*names)


def _starts(cells: DataFrame, hold) -> DataFrame:
    """(key, start, n, floor0.., the estimate, logdet) for cells (key, z0.., w, r0..)."""
    middle = cells.groupBy("key").agg(F.sum("w").alias("n"), *[(F.sum(r) / F.sum("w")).alias(f"floor{i}") for i, r in enumerate(R)], *[F.percentile(z, F.lit(0.5), F.col("w")).alias(f"m{i}") for i, z in enumerate(Z)])
    spread = cells.join(hold(middle), "key").groupBy("key").agg(*[F.first(c).alias(c) for c in ALONG], *[F.first(f"m{i}").alias(f"m{i}") for i in D], *[F.percentile(F.abs(F.col(f"z{i}") - F.col(f"m{i}")), F.lit(0.5), F.col("w")).alias(f"a{i}") for i in D])
    middle = written(spread.select("key", *ALONG, *[f"m{i}" for i in D], *[F.sqrt((1.4826 * F.col(f"a{i}")) ** 2 + F.col(f"floor{i}")).alias(f"s{i}") for i in D]), "middle")
    near = cells.join(hold(middle), "key")
    u = [(F.col(f"z{i}") - F.col(f"m{i}")) / F.col(f"s{i}") for i in D]
    size = F.greatest(F.sqrt(reduce(lambda a, b: a + b, [x * x for x in u])), F.lit(1e-9))
    whole = lambda c: F.round(c * UNIT).cast("long")
    sums = near.groupBy("key").agg(*_moments([whole(F.tanh(x)) for x in u], "t"), *_moments([whole(x / size) for x in u], "g"), *_moments([F.col(z) for z in Z], "x"))
    sums, n = middle.join(hold(sums), "key"), F.col("n").cast("double")

    def correlated(name: str, i: int, j: int) -> Column:
        spread = F.sqrt(F.greatest(_covariance(name, i, i, n), F.lit(1.0)) * F.greatest(_covariance(name, j, j, n), F.lit(1.0)))
        return F.col(f"s{i}") * F.col(f"s{j}") * (F.lit(1.0) if i == j else _covariance(name, i, j, n) / spread)

    floor = lambda i, j: F.col(f"floor{i}") if i == j else F.lit(0.0)
    kinds = (lambda i, j: F.col(f"s{i}") ** 2 if i == j else F.lit(0.0), lambda i, j: correlated("t", i, j), lambda i, j: correlated("g", i, j), lambda i, j: _covariance("x", i, j, n) + floor(i, j))
    values = lambda k: [(F.col(f"x{i}") / n if k == 3 else F.col(f"m{i}")).alias(f"m{i}") for i in D] + [kinds[k](i, j).alias(f"c{i}{j}") for i, j in PAIRS]
    each = sums.select("key", *ALONG, F.explode(F.array(*[F.struct(F.lit(k).alias("start"), *values(k)) for k in range(STARTS)])).alias("x")).select("key", *ALONG, "x.*")
    return _root(each, "key", "start", *ALONG).withColumn("logdet", F.lit(float("inf")))


def _binned(cells: DataFrame, estimate: DataFrame, hold) -> DataFrame:
    """Sums over the cells of each key, start and bin of distances, with the weight of all bins up to each."""
    near = distance(cells.join(hold(estimate.withColumnRenamed("logdet", "last")), "key"))
    near = near.withColumn("bin", F.floor(F.log2(1 + F.least(F.col("d2"), F.lit(1e12))) * BINS).cast("long"))
    bins = near.groupBy("key", "start", "bin").agg(F.sum("w").alias("w"), *[F.first(c).alias(c) for c in (*ALONG, "last")], *_moments([F.col(z) for z in Z], "x"))
    return bins.withColumn("upto", F.sum("w").over(Window.partitionBy("key", "start").orderBy("bin")))


def _summed(bins: DataFrame, part: Column, scale: float) -> DataFrame:
    """The estimates of bins that count in part."""
    part, along = part.cast("double"), ("key", "start", *ALONG, "last")
    sums = bins.filter(part > 0).groupBy("key", "start").agg(F.sum(F.col("w") * part).alias("total"), *[F.first(c).alias(c) for c in (*ALONG, "last")], *[F.sum(F.col(f"x{i}") * part).alias(f"x{i}") for i in D], *[F.sum(F.col(f"x{i}{j}") * part).alias(f"x{i}{j}") for i, j in PAIRS])
    n = F.col("total")
    return _root(sums.select(*along, *[(F.col(f"x{i}") / n).alias(f"m{i}") for i in D], *[(scale * _covariance("x", i, j, n) + (F.col(f"floor{i}") if i == j else F.lit(0.0))).alias(f"c{i}{j}") for i, j in PAIRS]), *along)


def _nearer(cells: DataFrame, estimate: DataFrame, share: float, hold) -> DataFrame:
    """A concentration step: the estimate of the share that is nearest, with the last step's logdet."""
    bins = _binned(cells, estimate, hold)
    need = F.ceil(F.col("n") * share)
    return _summed(bins, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (need - (F.col("upto") - F.col("w"))) / F.col("w"))), 1.0)


def minimum_covariance(cells: DataFrame, share: float = 0.75, rounds: int = 6, steps: int = 3) -> tuple[DataFrame, DataFrame]:
    """(key, the reweighted estimate) and (key, start, estimate, logdet) of the least determinant, for cells (key, z0.., w, r0..).

    A round, which is written, is of so many steps.
    """
    hold = _hold(cells.select("key").distinct())
    now, found = written(_starts(cells, hold), "estimate"), []
    for _ in range(rounds):
        after = now
        for _ in range(steps):
            after = _nearer(cells, after.drop("last"), share, hold)
        after = written(after, "estimate")
        found.append(after)
        now = after.filter("logdet < last - 1e-6")
        if not now.limit(1).count():
            break
    rows = reduce(DataFrame.unionByName, found).drop("last")
    least = rows.groupBy("key").agg(F.min_by(F.struct("start", *ALONG, *ESTIMATE, "logdet"), F.struct("logdet", "start")).alias("x")).select("key", "x.*")
    least = written(least, "estimate")
    bins = _binned(cells, least, hold)
    upper = lambda b: F.pow(F.lit(2.0), (b + 1) / BINS) - 1
    # scaled to be right for normal data, what then is near counts
    cut = F.min(F.when(F.col("upto") >= F.ceil(F.col("n") * share), F.col("bin"))).over(Window.partitionBy("key", "start"))
    bins = bins.withColumn("most", CHI_975 * F.greatest(F.lit(1.0), upper(cut) / CHI_75))
    near = (upper(F.col("bin")) <= F.col("most")) | (F.col("upto") <= F.ceil(F.col("n") * share))
    return written(_summed(bins, near, CONSISTENT).select("key", *ESTIMATE), "estimate"), least


def _places(cells: DataFrame, least: int) -> tuple[DataFrame, bool]:
    """(lang, source, key) for each language and source of cells, the key of a wider group where these are few; and whether all vectors are one more group."""
    own = cells.groupBy("lang", "source").agg(F.sum("w").alias("n")).withColumn("key", F.when(F.col("n") >= least, F.concat(F.lit("s"), F.length("lang").cast("string"), F.lit("|"), "lang", F.lit("|"), "source")))
    own = written(own, "places")
    by_lang = own.filter("key IS NULL").groupBy("lang").agg(F.sum("n").alias("more")).filter(F.col("more") >= least).select("lang", F.concat(F.lit("l"), "lang").alias("wide"))
    out = own.join(by_lang, "lang", "left").select("lang", "source", "n", F.coalesce("key", "wide").alias("key"))
    rest = out.filter("key IS NULL").agg(F.sum("n")).first()[0] or 0
    total = own.agg(F.sum("n")).first()[0] or 0
    last = F.lit("rest" if rest >= least else "all" if total >= least else None)
    return out.select("lang", "source", F.coalesce("key", last).alias("key")), 0 < rest < least <= total


def quality_verdicts(docs: DataFrame, cutoff: float = CHI_999, least: int = 40, min_words: int = 50, max_repeat_percent: int = 50, with_doc: bool = False) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, distance for each row of docs (doc_id, text, lang, source); doc, the whole row, if asked for."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = written(base_statistics(docs, with_doc).select("*", failed.alias("base_failed"), *vector(), *resolution()), "statistics")
    judged = rows.filter("NOT base_failed")
    cells = written(judged.groupBy("lang", "source", *Z).agg(F.count(F.lit(1)).alias("w"), *[F.sum(r).alias(r) for r in R]), "cells")
    places, with_all = _places(cells, least)
    places = written(places, "places")
    sums = [F.sum("w").alias("w"), *[F.sum(r).alias(r) for r in R]]
    fit = cells.join(_hold(places)(places), ["lang", "source"]).filter("key IS NOT NULL AND key <> 'all'").groupBy("key", *Z).agg(*sums)
    if with_all:
        fit = fit.unionByName(cells.groupBy(F.lit("all").alias("key"), *Z).agg(*sums))
    estimate, _ = minimum_covariance(written(fit, "cells"))
    places = written(places.join(estimate, "key", "left"), "places").drop("key")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *(["doc"] if with_doc else [])]
    if places.limit(HOLD + 1).count() <= HOLD:
        near = judged.join(F.broadcast(places), ["lang", "source"], "left")
    else:  # a language and source of very many rows is dealt to SALT tasks
        salted = places.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        near = judged.withColumn("salt", F.pmod(F.xxhash64("doc_id", "word_chars", *Z), F.lit(SALT)).cast("int")).join(salted, ["lang", "source", "salt"], "left")
    out = distance(near).select(*base, F.coalesce(F.col("d2") <= cutoff, F.lit(True)).alias("kept"), F.col("d2").alias("distance"))
    return out.unionByName(rows.filter("base_failed").select(*base, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))
