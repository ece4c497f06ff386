"""File, run and claim names."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, functions as F

# The name patterns of the exchange.
DIFF_NAME = "{day}_new_vaccinations.csv"
CHUNK_NAME = "%s_rebaseline_%02d-of-%02d.csv"
EVENT_NAME = "%03d_%s.json"


def landing_name(source: Column, stamp: Column, unique: Column) -> Column:
    """The name of a raw download of one source."""
    return F.concat(
        F.lit("vaccinations_"),
        F.replace(source, F.lit(" "), F.lit("_")),
        F.lit("_"),
        stamp,
        F.lit("_"),
        unique,
        F.lit(".csv"),
    )


def transformed_name(file_name: Column) -> Column:
    """The name of a landing file after transformation; folders fall away."""
    return F.concat(F.lit("transformed_"), F.substring_index(file_name, "/", -1))


def chunk_name(day: Column, chunk: Column, chunks: Column) -> Column:
    return F.format_string(CHUNK_NAME, day, chunk, chunks)


def event_name(seq: Column, event_type: Column) -> Column:
    return F.format_string(EVENT_NAME, seq, event_type)


def diff_name(as_of: dt.date) -> str:
    return DIFF_NAME.format(day=as_of.isoformat())


def new_run_id(kind: str, at: dt.datetime) -> str:
    """Made once by the caller and passed on, so a replay keeps its id."""
    return f"{kind}_{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
