"""Delivered files against confirmations and what still lies in the folder.

A file that was delivered and is gone from the folder has been imported.  A
delivery is known by its file name and by its remote id, which names its
content: two diffs of one day share a name and nothing else.  The three inputs
are tagged and folded per delivery in one aggregate, so copies collapse before
the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import file_age
from tidemark.functions.events import event
from tidemark.schema import CONFIRMED_HOW, DELIVERY_TARGET, REMINDER_DAYS


DELIVERY = ["file_name", "remote_id"]


def acknowledgements(events: DataFrame, target: str = DELIVERY_TARGET) -> DataFrame:
    """Ledger events as (file_name, remote_id, delivered, confirmed) rows."""
    delivered = (F.col("type") == "Delivered") & (F.col("data")["target"] == target)
    confirmed = F.col("type") == "ImportConfirmed"
    return events.filter(delivered | confirmed).select(
        F.col("data")["file_name"].alias("file_name"),
        F.coalesce(F.col("data")["remote_id"], F.lit("")).alias("remote_id"),
        delivered.alias("delivered"),
        confirmed.alias("confirmed"),
    )


def outstanding(acks: DataFrame, name: list[str]) -> DataFrame:
    """Names delivered and not confirmed."""
    return (
        acks.groupBy(*name)
        .agg(
            F.max("delivered").alias("_delivered"),
            F.max("confirmed").alias("_confirmed"),
        )
        .filter(F.col("_delivered") & ~F.col("_confirmed"))
        .select(*name)
    )


def file_status(
    acks: DataFrame,
    present: DataFrame,
    as_of: Column,
    days: int = REMINDER_DAYS,
    key: list[str] | None = None,
) -> DataFrame:
    """Each outstanding delivery: imported, awaiting or overdue.

    Deliveries are told apart by what ``present`` has of :data:`DELIVERY`.

    A present file whose name does not begin with a date never is overdue.
    """
    key = key or [name for name in DELIVERY if name in present.columns]
    no = F.lit(False)
    tagged = acks.select(*key, "delivered", "confirmed", no.alias("present"))
    tagged = tagged.unionByName(
        present.select(
            *key,
            no.alias("delivered"),
            no.alias("confirmed"),
            F.lit(True).alias("present"),
        )
    )
    age = file_age(F.col("file_name"), as_of)
    folded = (
        tagged.groupBy(*key)
        .agg(
            F.max("delivered").alias("delivered"),
            F.max("confirmed").alias("confirmed"),
            F.max("present").alias("present"),
        )
        .filter(F.col("delivered") & ~F.col("confirmed"))
    )
    status = (
        F.when(~F.col("present"), F.lit("imported"))
        .when(age >= days, F.lit("overdue"))
        .otherwise(F.lit("awaiting"))
    )
    return folded.select(*key, age.alias("age_days"), status.alias("status"))


def confirmations(status: DataFrame) -> DataFrame:
    """ImportConfirmed events for the files that are gone."""
    known = {name: F.col(name) for name in DELIVERY if name in status.columns}
    made = event("ImportConfirmed", **known, how=F.lit(CONFIRMED_HOW))
    return (
        status.filter(F.col("status") == "imported")
        .select("file_name", made.alias("_event"))
        .select("file_name", "_event.type", "_event.data")
    )
