"""Small helpers shared by the operators: private columns, joins, row keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import stage

#: Largest side, in bytes of its rows, that is broadcast; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20
#: Bytes a broadcast row takes besides its variable-length parts.
_ROW_BYTES = 64


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``_id``, ``_row`` and ``_text`` (bytes), and ``more``, whatever else ``docs`` holds.

    Rows that share an id but not their text differ in ``_row``; rows equal in
    both are told apart by nothing and get equal results.
    """
    return docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("_row"),
        F.col(f"`{text_col}`").cast("binary").alias("_text"),
        *[F.col(f"`{name}`") for name in more],
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, gone: DataFrame, keys: list[Column]) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` aren't a row of ``gone``; columns as they were."""
    names = [unused(docs, f"_key{i}") for i in range(len(keys))]
    marked = docs.withColumns(dict(zip(names, keys)))
    kept = join_rows(marked, gone.toDF(*names).distinct(), names, "left_anti")
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])


def join_rows(large: DataFrame, small: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with a staged side; broadcast only if its measured size allows it.

    Beyond the bound the smaller side is hashed per shuffle partition, so the
    larger one is not sorted.
    """
    small = stage(small, "side")
    parts: list[Column] = [F.lit(_ROW_BYTES)]
    for field in small.schema.fields:
        kind, name = field.dataType, F.col(f"`{field.name}`")
        if kind.typeName() in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(name), F.lit(0)))
        elif kind.typeName() == "array":
            inner = getattr(kind.elementType, "fields", None)
            each = 8 if inner is None else 16 + 8 * len(inner)
            parts.append(F.coalesce(F.size(name) * each, F.lit(0)))
        else:
            parts.append(F.lit(8))
    width = parts[0]
    for part in parts[1:]:
        width = width + part
    held = small.agg(F.sum(width.cast("long"))).first()[0] or 0
    if held <= BROADCAST_BYTES:
        return large.join(F.broadcast(small), on, how)
    return large.join(small.hint("shuffle_hash"), on, how)


def in_order_runs(
    batches: Iterable[pa.RecordBatch], key: str
) -> Iterator[pa.Table]:
    """Tables that each hold whole runs of equal ``key``, from rows sorted by it.

    What is held back is the last run of a batch, whose size the caller bounds.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key))
        last = column[-1]
        begin = batch.num_rows - 1
        low, high = 0, batch.num_rows - 1
        while low < high:  # first row of the last run
            middle = (low + high) // 2
            if column[middle] == last:
                high = middle
            else:
                low = middle + 1
        begin = low
        if begin == 0 and held and _last_key(held, key) == last:
            held.append(batch)
            continue
        if held or begin:
            yield pa.Table.from_batches([*held, batch.slice(0, begin)])
        held = [batch.slice(begin)]
    if held:
        yield pa.Table.from_batches(held)


def _last_key(held: list[pa.RecordBatch], key: str):
    batch = held[-1]
    return batch.column(batch.schema.get_field_index(key))[-1]
