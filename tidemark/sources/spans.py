"""Records that go on over line ends, in files that are split all the same.

Lines are read by many tasks, each line in the split it begins in.  Whether a
line begins inside a quoted field depends on all lines before it, but a line
does one of four things to that: leaves it as it is, turns it round, ends
inside, or ends outside.  Such steps compose.  So each split says where it ends
for both ways it may begin, the splits of a file are composed in order, and
then every split knows how it begins and cuts its own records.  A record belongs
to the split its first line is in; the lines of the next splits that it goes on
in are sent there.

Only narrow columns are ordered within a split; only the lines of records that
do span are grouped.  A record beyond :data:`MOST_BYTES` (a quote never closed
makes one of the rest of a file) is marked and never put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import stage

#: The longest record that is put together, in bytes.
MOST_BYTES = 1 << 20
#: Stands in for a longer record; no file line can be this.
OVERSIZED = "\x00\n"

_OUT, _START, _IN, _AFTER = range(4)
#: What a quote makes of each state: literal, opening, closing or first of two, second of two.
_QUOTE = [_OUT, _IN, _AFTER, _IN]


def _ends_inside(value: Column, inside: bool, separator: str) -> Column:
    """Whether a line that begins at a field (or inside quotes) ends inside quotes."""
    parts = F.split(value, '"')

    def past(state: Column, text: Column) -> Column:
        after = F.when(text.endswith(separator), F.lit(_START)).otherwise(F.lit(_OUT))
        return F.when((text == "") | (state == _IN), state).otherwise(after)

    def step(state: Column, text: Column) -> Column:
        return past(F.element_at(F.lit(_QUOTE), state + 1), text)

    first = past(F.lit(_IN if inside else _START), F.get(parts, F.lit(0)))
    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), first, step)
    return F.when(value.contains('"'), walked == _IN).otherwise(F.lit(inside))


def opens(value: Column, separator: str) -> Column:
    """True if a record that begins with this line goes on after it."""
    return _ends_inside(value, False, separator)


def _composed(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """``_fixed`` and ``_turned``: what the rows of ``group`` before each one do together.

    ``_fixed`` is how the last of them that ends one way only ended, null if none
    does; ``_turned`` whether what follows it turns that (or the group's
    beginning) round.
    """
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(F.col("_out") & ~F.col("_in"), F.lit(1)).otherwise(F.lit(0))
    fixes = F.col("_out") == F.col("_in")
    counted = rows.withColumn("_turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    last = F.last(F.when(fixes, F.struct(F.col("_out").alias("to"), "_turns")), ignorenulls=True)
    return counted.withColumn("_last", last.over(before)).select(
        "*",
        F.col("_last.to").alias("_fixed"),
        ((F.col("_turns") - F.coalesce("_last._turns", F.lit(0))) % 2 == 1).alias("_turned"),
    ).drop("_turns", "_last")


def _begins_inside(given: Column) -> Column:
    """Whether a row begins inside, if its group begins as ``given``."""
    return F.coalesce(F.col("_fixed"), given) != F.col("_turned")


def records(lines: DataFrame, separator: str, keep_empty: bool) -> DataFrame:
    """``value, file, block, place``: a row per record, from a row per line.

    ``place`` counts the records of a split from 1.  Line ends inside a record
    are written as one line feed, as text readers do.  Empty lines between
    records are dropped unless ``keep_empty``.
    """
    value = F.col("value")
    coded = lines.select(
        "value", "file", "block", "place",
        _ends_inside(value, False, separator).alias("_out"),
        _ends_inside(value, True, separator).alias("_in"),
    )
    in_split = Window.partitionBy("file", "block").orderBy("place")
    known = _composed(coded, ["file", "block"], "place")
    ways = {"out": F.lit(False), "in": F.lit(True)}
    ends = {}
    for way, given in ways.items():
        inside = _begins_inside(given)
        ends[f"_{way}"] = F.max_by(F.when(inside, F.col("_in")).otherwise(F.col("_out")), "place")
        ends[f"_last_{way}"] = F.max(F.when(~inside, F.col("place")))
    splits = stage(known.groupBy("file", "block").agg(*[c.alias(n) for n, c in ends.items()]), "splits")
    # One row per split: which way it begins, and the last record begun before it.
    splits = _composed(splits, ["file"], "block").withColumn("_given", _begins_inside(F.lit(False)))
    last = F.when(F.col("_given"), F.col("_last_in")).otherwise(F.col("_last_out"))
    begun = F.when(last.isNotNull(), F.struct("block", last.alias("place")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file", "block", "_given", F.last(begun, ignorenulls=True).over(earlier).alias("_head")
    )
    placed = known.join(stage(splits, "split-begins"), ["file", "block"])
    placed = placed.withColumn("_inside", _begins_inside(F.col("_given"))).withColumn(
        "_goes_on", F.when(F.col("_inside"), F.col("_in")).otherwise(F.col("_out"))
    )
    starts = ~F.col("_inside")
    if not keep_empty:
        starts = starts & ((value != "") | F.col("_goes_on"))
    so_far = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last(F.when(~F.col("_inside"), F.struct("block", "place")), ignorenulls=True)
    placed = placed.select(
        "value", "file", "block", "place", "_inside", "_goes_on", starts.alias("_starts"),
        F.count(F.when(starts, 1)).over(so_far).alias("_number"),
        F.coalesce(own.over(so_far), F.col("_head")).alias("_record"),
    )
    spans = F.col("_inside") | F.col("_goes_on")
    whole = placed.where(~spans & F.col("_starts")).select(
        "value", "file", "block", F.col("_number").alias("place")
    )
    parts = stage(placed.where(spans), "spans")
    key = ["file", "_record"]
    sizes = parts.groupBy(*key).agg(F.sum(F.octet_length("value") + 1).alias("_bytes"))
    large = stage(sizes.where(F.col("_bytes") > MOST_BYTES).select(*key), "oversized")
    some_large = not large.isEmpty()
    fitting = parts.join(large, key, "left_anti") if some_large else parts
    pieces = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    number = F.max(F.when(F.col("_starts"), F.col("_number")))
    joined = fitting.groupBy(*key).agg(pieces.alias("_pieces"), number.alias("_number")).select(
        F.array_join(F.col("_pieces.value"), "\n").alias("value"),
        "file", F.col("_record.block").alias("block"), F.col("_number").alias("place"),
    )
    found = whole.unionByName(joined)
    if some_large:
        marked = parts.where("_starts").join(large, key, "left_semi")
        found = found.unionByName(
            marked.select(F.lit(OVERSIZED).alias("value"), "file", "block", F.col("_number").alias("place"))
        )
    return found
