"""Ledger event payloads: a type and a flat map of text, never record content."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.schema import EVENT_FIELDS, MORE_FIELDS


def check_fields(event_type: str, names: list[str]) -> None:
    expected = EVENT_FIELDS[event_type]
    if expected is None:
        return
    more = set(names) - set(expected)
    if not set(expected) <= set(names) or not more <= set(MORE_FIELDS.get(event_type, [])):
        raise ValueError(f"{event_type} carries {expected}, not {names}")


def payload(event_type: str, **values: Column) -> Column:
    """The ``data`` map of one event type, built from columns."""
    check_fields(event_type, list(values))
    entries: list[Column] = []
    for name, value in values.items():
        entries += [F.lit(name), F.coalesce(value.cast("string"), F.lit(""))]
    return F.create_map(*entries)


def event(event_type: str, **values: Column) -> Column:
    return F.struct(F.lit(event_type).alias("type"), payload(event_type, **values).alias("data"))


def detail(data: Column) -> Column:
    """A payload as ``name=value`` pairs in the order they were written."""
    pairs = F.transform(
        F.map_entries(data), lambda entry: F.concat_ws("=", entry["key"], entry["value"])
    )
    return F.array_join(pairs, ", ")
