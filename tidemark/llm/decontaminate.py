"""Benchmark decontamination by shared shingles of item-sized windows.

Columns only; no Python runs on rows.  A window of a document has as many words
as a benchmark item; its shingles are its runs of five lower-cased words.  A
document shorter than an item has one window for it, the whole document.

1. Shingles of all documents are met with those of the items.  A window at
   least 0.8 similar to an item of its size has at least three fifths of its
   shingles among those of items of that size (weights lie between 1 and 2), so
   the others need no comparison.
2. Each remaining window, once per content, meets the items that share shingles
   with it; the shared weight is summed over them.
3. A pair whose shared weight is under 0.8 of the item's can't be similar; the
   weighted similarity of window and item decides the others.

No step loses a similar window.  A fingerprint of fixed length would: at a
similarity of 0.8 the share of bits that differ has no bound that an index of a
few changed bits reaches.
Shingles are compared by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.frames import join_rows, without
from tidemark.llm.quality import WORD_GAP
from tidemark.session import stage

SHINGLE = 5
SIMILARITY = 0.8
#: A shingle of one item or of none counts twice as much as a shared one.
COMMON, RARE = 1, 2
#: Of a window's shingles, how many must be known: see step 1.
LEAST_KNOWN = 0.6


def shingle_hashes(rows: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """``keep``, ``_n`` words and ``_g``, the hashes of all shingles in order.

    Explode ``_g`` with the outer forms only: the others make Spark test its size
    below the projections, which nests them and costs the square of a text.
    """
    words = rows.select(
        *keep,
        F.filter(
            F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), WORD_GAP),
            lambda word: word != "",
        ).alias("_w"),
    )
    ones = words.select(
        *keep, F.size("_w").alias("_n"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h")
    )
    twos = ones.withColumn("_h2", F.transform("_h", lambda h, i: F.xxhash64(h, F.get("_h", i + 1))))
    fours = twos.withColumn(
        "_h4", F.transform("_h2", lambda h, i: F.xxhash64(h, F.get("_h2", i + 2)))
    )
    fives = fours.withColumn(
        "_g", F.transform("_h4", lambda h, i: F.xxhash64(h, F.get("_h", i + 4)))
    )
    return fives.select(
        *keep,
        "_n",
        F.slice("_g", 1, F.greatest(F.col("_n") - (SHINGLE - 1), F.lit(0))).alias("_g"),
    )


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """The items' shingles with count and weight, and each item's weight."""
    hashed = shingle_hashes(
        benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("_text")),
        F.col("_text"),
        ["item"],
    )
    rows = hashed.select(
        "item", F.col("_n").alias("size"), F.explode_outer("_g").alias("_g")
    ).where("item is not null and _g is not null")
    counts = rows.groupBy("item", "size", "_g").agg(F.count(F.lit(1)).alias("_c"))
    spread = counts.groupBy("_g").agg(F.countDistinct("item").alias("n"))
    weights = spread.select("_g", F.when(F.col("n") > 1, COMMON).otherwise(RARE).alias("_w"))
    weighted = stage(counts.join(weights, "_g"), "item-weights")
    totals = weighted.groupBy("item", "size").agg(F.sum(F.col("_c") * F.col("_w")).alias("item_weight"))
    return stage(weighted.join(totals, ["item", "size"]), "item-shingles")


def _windows(hits: DataFrame) -> DataFrame:
    """``_row, size, starts``: windows enough of whose shingles are known.

    Each hit opens the windows that hold it; a running sum over starts counts
    the hits of each window.
    """
    reach = F.col("size") - SHINGLE
    steps = hits.select(
        "_row",
        "size",
        "_n",
        F.explode(
            F.array(
                F.struct(F.greatest(F.col("pos") - reach, F.lit(0)).alias("s"), F.lit(1).alias("d")),
                F.struct((F.col("pos") + 1).alias("s"), F.lit(-1).alias("d")),
            )
        ).alias("step"),
    )
    folded = steps.groupBy("_row", "size", "_n", F.col("step.s").alias("s")).agg(
        F.sum("step.d").alias("d")
    )
    order = Window.partitionBy("_row", "size", "_n").orderBy("s")
    counted = folded.select(
        "_row", "size", "_n", "s",
        F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("known"),
        F.lead("s").over(order).alias("next"),
    )
    # A document shorter than the item is one window, from its first word.
    last = F.least(F.col("next") - 1, F.greatest(F.col("_n") - F.col("size"), F.lit(0)))
    return counted.where(
        (F.col("known") >= LEAST_KNOWN * (F.col("size") - (SHINGLE - 1))) & (last >= F.col("s"))
    ).select("_row", "size", F.explode_outer(F.sequence("s", last)).alias("start"))


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``text_hash, item, similarity, start``: texts with a window like an item.

    One row per text and item: its most similar window, the first of equal ones.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"windows are searched for similarities of {SIMILARITY} and more")
    item_shingles = _items(benchmark, item_col, item_text_col)
    known = item_shingles.select("_g", "size").distinct()
    rows = docs.select(
        F.xxhash64(F.col(f"`{text_col}`")).alias("_row"), F.col(f"`{text_col}`").alias("_text")
    )
    everywhere = shingle_hashes(rows, F.col("_text"), ["_row"]).select(
        "_row", "_n", F.posexplode_outer("_g").alias("pos", "_g")
    )
    # Shorter documents count as long as they have shingles enough for step 1.
    enough = F.col("_n") - (SHINGLE - 1) >= LEAST_KNOWN * (F.col("size") - (SHINGLE - 1))
    hits = join_rows(everywhere, known, ["_g"], "inner").where(enough)
    hits = stage(hits.select("_row", "_n", "size", "pos").distinct(), "hits")
    places = stage(_windows(hits), "windows")
    texts = join_rows(rows, places.select("_row").distinct(), ["_row"], "inner")
    texts = shingle_hashes(texts, F.col("_text"), ["_row"]).dropDuplicates(["_row"])
    cut = F.slice("_g", F.col("start") + 1, F.col("size") - (SHINGLE - 1))
    windows = stage(
        places.join(texts, "_row").select("_row", "size", "start", cut.alias("_g"))
        .withColumn("window", F.xxhash64("size", "_g"))
        .withColumn("n_words", F.size("_g") + (SHINGLE - 1)),
        "cut",
    )
    distinct = windows.select("window", "size", "_g").dropDuplicates(["window"])
    counts = (
        distinct.select("window", "size", F.explode("_g").alias("_g"))
        .groupBy("window", "size", "_g").agg(F.count(F.lit(1)).alias("_c"))
    )
    weights = item_shingles.select("_g", "_w").distinct()
    weighted = stage(
        join_rows(counts, weights, ["_g"], "left").withColumn("_w", F.coalesce("_w", F.lit(RARE))),
        "window-shingles",
    )
    totals = weighted.groupBy("window").agg(F.sum(F.col("_c") * F.col("_w")).alias("weight"))
    shared = (
        weighted.join(item_shingles.select("item", "size", "_g", "item_weight", F.col("_c").alias("_ic")), ["size", "_g"])
        .groupBy("window", "item", "item_weight")
        .agg(F.sum(F.col("_w") * F.least("_c", "_ic")).alias("shared"))
        .where(F.col("shared") / F.col("item_weight") >= similarity)
    )
    alike = (
        shared.join(totals, "window")
        .withColumn(
            "similarity",
            F.col("shared") / (F.col("weight") + F.col("item_weight") - F.col("shared")),
        )
        .where(F.col("similarity") >= similarity)
        .select("window", "item", "similarity")
    )
    best = F.struct(F.col("similarity"), (-F.col("start")).alias("back"), "n_words")
    found = (
        windows.select("_row", "window", "n_words", "start")
        .join(alike, "window")
        .groupBy("_row", "item")
        .agg(F.max(best).alias("best"))
    )
    return found.select(
        F.col("_row").alias("text_hash"),
        "item",
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.back")).alias("start"),
        F.col("best.n_words").alias("n_words"),
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``id_col, item_col, similarity, start, n_words`` for each leak found.

    ``start`` counts words from zero; ``n_words`` are the window's, fewer than the
    item's where the whole document is shorter than the item.  Texts without a leak have no row; rows
    with equal texts have equal leaks, whatever their ids (null ids included).
    Null and empty texts leak nothing; null items, and items of fewer than five
    words, are not looked for.  Equal items are each reported.  Other columns
    don't matter.  Empty tables give an empty result.
    """
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col, similarity)
    ids = docs.select(
        F.col(f"`{id_col}`").alias("_doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash")
    )
    return join_rows(ids, found, ["text_hash"], "inner").select(
        F.col("_doc").alias(id_col),
        F.col("item").alias(item_col),
        "similarity",
        "start",
        "n_words",
    )


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col)
    return without(docs, found.select("text_hash"), [F.xxhash64(F.col(f"`{text_col}`"))])
