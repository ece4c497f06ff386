"""Quality rules: base rules per text, then robust multivariate outliers.

Everything is column expressions and aggregates; no Python runs on rows.

Counts of each text become a vector of five transformed statistics.  Per
language and source the minimum covariance determinant is sought: from two
robust starts, concentration steps keep the half of the rows nearest to the
last estimate, and the start that ends with the smaller determinant wins; a
reweighting step then takes all rows within a chi-square bound.  A row is
rejected if its squared Mahalanobis distance exceeds ``CUTOFF``.  A floor on
each standard deviation is added to the covariance, since most clean texts
have no symbol and no repeated line at all.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import join_rows, without
from tidemark.session import stage

#: White space between words, the counted symbols, the base rules.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
NOT_UPPER = r"[^\p{Lu}]+"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: Least rows of a language and source with an estimate of their own; smaller
#: ones are taken together per language, then over all languages.
LEAST_GROUP = 50
#: Statistics: name and least standard deviation.
FLOORS = (("word", 0.08), ("symbol", 0.1), ("upper", 0.08), ("line", 0.2), ("repeat", 0.2))
SIZE = len(FLOORS)
#: Concentration steps of each start.
STEPS = 3
#: Fixed values for five dimensions: the factor that makes the covariance of
#: the central half consistent, the 0.975 quantile of chi-square and the factor
#: that goes with it, and the 0.999 quantile.
HALF_FACTOR = 1.914
REWEIGHT_BOUND = 12.833
REWEIGHT_FACTOR = 1.055
CUTOFF = 20.515


def with_statistics(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with a struct ``_s`` of the counts of ``text``; a null text counts as empty.

    Windows are compared by a 64-bit hash of their words.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    window = REPEAT_WINDOW
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text.alias("_t"))
    cut = kept.select(
        "_row",
        "_t",
        F.filter(F.split("_t", WORD_GAP), lambda word: word != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda line: line.rlike(WORD)).alias("_l"),
    )
    counted = cut.select(
        "_row",
        F.size("_w").alias("_n"),
        F.length(F.array_join("_w", "")).alias("_chars"),
        F.length(F.regexp_replace("_t", NOT_SYMBOLS, "")).alias("_symbols"),
        F.length(F.regexp_replace("_t", NOT_UPPER, "")).alias("_upper"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("_dup"),
        F.size("_l").alias("_lines"),
        F.transform("_w", lambda word: F.xxhash64(word)).alias("_h"),
    )
    # Hashes of runs of 2, 4 and 8 words, each from two of the runs before.
    hashed = counted
    run = 1
    while run < window:
        step = run
        hashed = hashed.withColumn(
            "_h", F.transform("_h", lambda h, at: F.xxhash64(h, F.get("_h", at + step)))
        )
        run *= 2
    hashed = hashed.withColumn("_h", F.slice("_h", 1, F.greatest(F.col("_n") - (window - 1), F.lit(0))))
    sorted_ = hashed.withColumn(
        "_h",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.array_sort(F.transform("_h", lambda h, at: F.struct(h.alias("h"), at.alias("at")))),
        ).otherwise(F.expr("cast(array() as array<struct<h:bigint,at:int>>)")),
    )

    def twice(item: Column, at: Column) -> Column:
        near = (F.get("_h", at - 1)["h"].eqNullSafe(item["h"])) | (
            F.get("_h", at + 1)["h"].eqNullSafe(item["h"])
        )
        return F.when(near, item["at"])

    places = sorted_.withColumn(
        "_h", F.array_sort(F.filter(F.transform("_h", twice), lambda at: at.isNotNull()))
    )
    covered = F.aggregate(
        "_h",
        F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
        lambda seen, at: F.struct(
            (seen["n"] + F.least(F.lit(window), at - seen["last"])).alias("n"), at.alias("last")
        ),
        lambda seen: seen["n"],
    )
    counts = places.select(
        "_row",
        F.struct(
            F.col("_n").cast("long").alias("n_words"),
            F.col("_chars").cast("long").alias("word_chars"),
            F.col("_symbols").cast("long").alias("n_symbols"),
            F.col("_dup").cast("long").alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
            F.col("_upper").cast("long").alias("n_upper"),
            F.col("_lines").cast("long").alias("n_lines"),
        ).alias("_s"),
    )
    return counts.select("_row.*", "_s")


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def _vector(counts: str) -> list[Column]:
    """The transformed statistics; short texts are drawn towards a middle value."""
    c = lambda name: F.col(f"{counts}.{name}").cast("double")
    return [
        F.log((c("word_chars") + 100) / (c("n_words") + 20)),
        F.sqrt(c("n_symbols") / (c("n_words") + 20)),
        F.sqrt(c("n_upper") / (c("word_chars") + 100)),
        F.sqrt(c("n_dup_lines") / (c("n_lines") + 4)),
        F.sqrt(c("n_repeat_words") / (c("n_words") + 20)),
    ]


def _groups(rows: DataFrame) -> DataFrame:
    """``_lang, _source, _group``: whose estimate a language and source uses."""
    sizes = rows.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("n") >= LEAST_GROUP
    named = sizes.withColumn(
        "_group", F.when(own, F.concat_ws("\x1f", F.lit("own"), "_lang", "_source"))
    )
    rest = named.where("_group is null").groupBy("_lang").agg(F.sum("n").alias("m"))
    return named.join(rest, "_lang", "left").select(
        "_lang",
        "_source",
        F.coalesce(
            "_group",
            F.when(F.col("m") >= LEAST_GROUP, F.concat_ws("\x1f", F.lit("lang"), "_lang")),
            F.lit("all"),
        ).alias("_group"),
    )


def _moments(weight: Column) -> list[Column]:
    """Aggregates of the rows for which ``weight`` holds."""
    out = [F.count(F.when(weight, 1)).alias("n")]
    for i in range(SIZE):
        out.append(F.sum(F.when(weight, F.col(f"x{i}"))).alias(f"s{i}"))
        for j in range(i + 1):
            product = F.col(f"x{i}") * F.col(f"x{j}")
            out.append(F.sum(F.when(weight, product)).alias(f"s{i}{j}"))
    return out


def _estimate(moments: DataFrame, factor: float, keep: list[str]) -> DataFrame:
    """Means ``m``, Cholesky factor ``l`` and the determinant from :func:`_moments`."""
    n = F.greatest(F.col("n"), F.lit(1)).cast("double")
    means = moments.select(
        *keep, "n", *[(F.coalesce(f"s{i}", F.lit(0.0)) / n).alias(f"m{i}") for i in range(SIZE)],
        *[f"s{i}{j}" for i in range(SIZE) for j in range(i + 1)],
    )
    for i in range(SIZE):
        for j in range(i + 1):
            cov = F.coalesce(f"s{i}{j}", F.lit(0.0)) / n - F.col(f"m{i}") * F.col(f"m{j}")
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) * factor + FLOORS[i][1] ** 2
            else:
                cov = cov * factor
            known = [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)]
            cov = reduce(lambda a, b: a - b, known, cov)
            if i == j:
                value = F.sqrt(F.greatest(cov, F.lit(1e-6)))
            else:
                value = cov / F.col(f"l{j}{j}")
            means = means.withColumn(f"l{i}{j}", value)
    det = reduce(lambda a, b: a * b, [F.col(f"l{i}{i}") for i in range(SIZE)])
    return means.select(
        *keep, "n", det.alias("det"),
        F.array(*[f"m{i}" for i in range(SIZE)]).alias("m"),
        F.array(*[f"l{i}{j}" for i in range(SIZE) for j in range(i + 1)]).alias("l"),
    )


def _with_distance(rows: DataFrame, name: str) -> DataFrame:
    """Adds the squared Mahalanobis distance of ``x`` from ``m`` under ``l``."""
    at = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(SIZE) for j in range(i + 1))}
    for i in range(SIZE):
        value = F.col(f"x{i}") - F.get("m", F.lit(i))
        for j in range(i):
            value = value - F.get("l", F.lit(at[i, j])) * F.col(f"_y{j}")
        rows = rows.withColumn(f"_y{i}", value / F.get("l", F.lit(at[i, i])))
    total = reduce(add, [F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(SIZE)])
    return rows.withColumn(name, total).drop(*[f"_y{i}" for i in range(SIZE)])


def estimates(rows: DataFrame) -> DataFrame:
    """``_group, n, det, m, l`` from ``_group, x0..``: one row per group."""
    xs = [f"x{i}" for i in range(SIZE)]
    rows = rows.select("_group", *xs)
    medians = rows.groupBy("_group").agg(
        *[F.percentile_approx(x, 0.5, 1000).alias(f"c{i}") for i, x in enumerate(xs)]
    )
    centred = join_rows(rows, medians, ["_group"], "inner")
    spread = centred.groupBy("_group").agg(
        *[
            F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5, 1000).alias(f"d{i}")
            for i in range(SIZE)
        ]
    )
    scaled = join_rows(centred, spread, ["_group"], "inner")
    far = {"mad": [], "floor": []}
    for i, (_, floor) in enumerate(FLOORS):
        off = F.col(f"x{i}") - F.col(f"c{i}")
        far["mad"].append(F.pow(off / F.greatest(1.4826 * F.col(f"d{i}"), F.lit(floor)), 2))
        far["floor"].append(F.pow(off / floor, 2))
    starts = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("start"), reduce(add, parts).alias("d"))
                for name, parts in far.items()
            ]
        )
    )
    key = ["_group", "_start"]
    apart = scaled.select("_group", *xs, starts.alias("_o")).select(
        "_group", F.col("_o.start").alias("_start"), F.col("_o.d").alias("_d"), *xs
    )
    both = rows.select(
        "_group", *xs, F.explode(F.array(*[F.lit(name) for name in far])).alias("_start")
    )
    found = None
    for _ in range(STEPS):
        bound = apart.groupBy(*key).agg(F.percentile_approx("_d", 0.5, 1000).alias("_b"))
        near = join_rows(apart, bound, key, "inner")
        moments = near.groupBy(*key).agg(*_moments(F.col("_d") <= F.col("_b")))
        found = stage(_estimate(moments, HALF_FACTOR, key), "halves")
        apart = _with_distance(join_rows(both, found, key, "inner"), "_d").select(*key, "_d", *xs)
    best = found.groupBy("_group").agg(F.min_by("_start", "det").alias("_start"))
    best = found.join(best, key).drop("_start")
    near = _with_distance(join_rows(rows, best, ["_group"], "inner"), "_d")
    moments = near.groupBy("_group").agg(*_moments(F.col("_d") <= REWEIGHT_BOUND))
    return _estimate(moments, REWEIGHT_FACTOR, ["_group"])


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: the id, the counts, ``base_failed``, ``kept``.

    ``distance`` is the squared Mahalanobis distance (null where the base rules
    failed) and ``text_hash`` tells rows of one id apart.  A null text has no
    words and fails the base rules; null languages and sources form groups of
    their own; groups of under ``LEAST_GROUP`` rows are judged together, and if
    even all of these are fewer, the base rules alone decide.  Equal rows get
    equal verdicts.  Other columns don't matter.  An empty table gives an empty
    result.
    """
    inner = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{text_col}`").alias("_text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("\x00")).alias("_lang"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("\x00")).alias("_source"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
    )
    counted = with_statistics(inner, F.col("_text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    counted = stage(
        counted.select(
            "_id", "_lang", "_source", "text_hash",
            *[F.col(f"_s.{name}").alias(name) for name in names],
            base_failed(F.col("_s.n_words"), F.col("_s.n_repeat_words")).alias("base_failed"),
            *[value.alias(f"x{i}") for i, value in enumerate(_vector("_s"))],
        ),
        "counts",
    )
    judged = counted.where("not base_failed")
    grouped = join_rows(counted, _groups(judged), ["_lang", "_source"], "left")
    known = estimates(grouped.where("not base_failed")).where(F.col("n") >= 2 * SIZE)
    apart = _with_distance(join_rows(grouped, known.select("_group", "m", "l"), ["_group"], "left"), "_d")
    far = F.when(~F.col("base_failed"), F.col("_d"))
    return apart.select(
        F.col("_id").alias(id_col),
        *names,
        "base_failed",
        (~F.col("base_failed") & (F.coalesce(far, F.lit(0.0)) <= CUTOFF)).alias("kept"),
        far.alias("distance"),
        "text_hash",
    )


def keep_good(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """The rows that :func:`judge` keeps, with all their columns."""
    judged = judge(docs, id_col, text_col, lang_col, source_col)
    gone = judged.where("not kept").select(F.xxhash64(id_col).alias("id_hash"), "text_hash")
    return without(docs, gone, [F.xxhash64(f"`{id_col}`"), F.xxhash64(f"`{text_col}`")])
