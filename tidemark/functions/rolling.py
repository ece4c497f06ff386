"""A digest of lines that knows their order and can be put together from parts.

A text's digest is a polynomial in a fixed base whose coefficients are numbers
of its lines, modulo a prime; two bases are taken side by side.  A part that
starts at line ``k`` of the whole counts ``base ** k`` times its own digest, so
parts are digested apart, by any number of tasks, and added: see
:func:`combine`.  Where a file is cut into splits makes no difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The prime and the two bases.
MODULUS = (1 << 31) - 1
BASES = (1_000_003, 2_147_001_325)
#: Hexadecimal digits of a line's SHA-256 that each of its numbers takes.
_HEX = 7
#: Bits of an exponent looked up at a time, and bits that an exponent may have.
_STEP, _BITS = 8, 40
#: Row numbers within a Spark partition, as its row ids have them.
_ROW = (1 << 33) - 1


def power(base: int, exponent: Column) -> Column:
    """``base ** exponent`` modulo the prime, from tables of a few powers."""
    found: Column | None = None
    for low in range(0, _BITS, _STEP):
        first = pow(base, 1 << low, MODULUS)
        # Folded to one constant; a literal for each power would weigh on every plan.
        powers = ",".join(str(pow(first, digit, MODULUS)) for digit in range(1 << _STEP))
        table = F.split(F.lit(powers), ",").cast("array<long>")
        digit = F.shiftright(exponent, low).bitwiseAND(F.lit((1 << _STEP) - 1)).cast("int")
        factor = F.get(table, digit)
        found = factor if found is None else found * factor % MODULUS
    return found


def numbers(line: Column) -> list[Column]:
    """The two numbers of a line; text that is not UTF-8 counts as if replaced."""
    digest = F.sha2(F.make_valid_utf8(line), 256)
    return [
        F.conv(F.substring(digest, 1 + _HEX * i, _HEX), 16, 10).cast("long") + 1
        for i in range(len(BASES))
    ]


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """Line count and digests of a text followed by another."""
    n = left[0]
    both = [
        (one + pow(base, n, MODULUS) * other) % MODULUS
        for base, one, other in zip(BASES, left[1:], right[1:])
    ]
    return (n + right[0], *both)


def written(n: Column, first: Column, second: Column) -> Column:
    """A digest as text: the number of lines and both numbers."""
    return F.format_string("%d-%08x%08x", n, first, second)


def split_sums(line: Column, place: Column) -> dict[str, Column]:
    """Aggregates over the lines of one split of one file.

    ``place`` is the row id that Spark gives in reading order.  Only numbers are
    kept, so the lines fold in a hash aggregate.
    """
    row = place.bitwiseAND(F.lit(_ROW))
    kept = {"_n": F.count(F.lit(1)), "_row": F.min(row)}
    for i, (base, number) in enumerate(zip(BASES, numbers(line))):
        kept[f"_s{i}"] = F.sum(number * power(base, row) % MODULUS)
    return kept


def with_digest(splits: DataFrame, file: str, block: str, name: str) -> DataFrame:
    """``file`` and its digest, from one row per split made by :func:`split_sums`.

    A split's sums start at the row it had in its partition; they are moved to
    the line it has in its file, which the splits before it tell.
    """
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    # Powers repeat after MODULUS - 1, so a negative exponent has a positive one.
    moved = splits.withColumn("_by", F.pmod(start - F.col("_row"), F.lit(MODULUS - 1)))
    sums = [
        F.sum(F.col(f"_s{i}") % MODULUS * power(base, F.col("_by")) % MODULUS) % MODULUS
        for i, base in enumerate(BASES)
    ]
    return moved.groupBy(file).agg(written(F.sum("_n"), *sums).alias(name))
