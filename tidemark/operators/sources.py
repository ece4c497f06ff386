"""A run's sources by name: what each school sent, and where one failed.

Schools, the newest listing entry of each, the digests of their rosters and the
audit of what landed are folded into one row per school.  Ledger events of the
sources and the counts that a decision needs are read off these rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.events import payload
from tidemark.schema import (
    NO_RESULT,
    NO_ROSTER,
    NOT_LANDED,
    REJECTED,
    SOURCE_FETCH,
    SOURCE_PARSE,
    SOURCE_SUBMIT,
)


def landed_name(file: Column) -> Column:
    """The name of a landed extract: its folder's, if it is a folder of parts, else its own."""
    folder = F.regexp_extract(file, r"/file_name=([^/]+)/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.substring_index(file, "/", -1))


def landed(files: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row per landed extract; one of several parts is taken if all of them are."""
    reasons = rejects.select("file", "reason")
    parts = files.join(reasons, "file", "left").withColumn("name", landed_name(F.col("file")))
    return parts.groupBy("name").agg(
        F.min(F.col("accepted").cast("int")).cast("boolean").alias("accepted"),
        F.sum("bytes").alias("byte_size"),
        F.array_join(F.sort_array(F.collect_list(F.struct("file", "content_hash")))["content_hash"], "+")
        .alias("content_hash"),
        F.min("reason").alias("reason"),
    )


def by_school(
    schools: DataFrame, latest: DataFrame, rosters: DataFrame, extracts: DataFrame
) -> DataFrame:
    """One row per school, and one for each extract that no school's listing names.

    ``schools`` has ``district_id, school_id, query_file``; ``latest`` the ``url``
    of a school's newest result; ``rosters`` digests by ``path``; ``extracts`` is
    of :func:`landed`.
    """
    listed = latest.select(
        "district_id", "school_id", "url", F.substring_index("url", "/", -1).alias("name")
    )
    rosters = rosters.select(
        F.col("path").alias("query_file"), F.col("digest").alias("roster_digest")
    )
    asked = (
        schools.select("district_id", "school_id", "query_file")
        .join(listed, ["district_id", "school_id"], "left")
        .join(rosters, "query_file", "left")
    )
    found = asked.join(extracts, "name", "full_outer")
    taken = F.coalesce("accepted", F.lit(False))
    error = (
        F.when(F.col("url").isNull(), F.lit(NO_RESULT))
        .when(F.col("accepted").isNull(), F.lit(NOT_LANDED))
        .when(~taken, F.concat(F.lit(f"{REJECTED}:"), F.col("reason")))
    )
    step = F.when(F.col("accepted").isNull(), F.lit(SOURCE_FETCH)).when(~taken, F.lit(SOURCE_PARSE))
    return found.select(
        "district_id", "school_id", "query_file", "roster_digest", "url", "name",
        F.col("accepted").isNotNull().alias("fetched"),
        taken.alias("accepted"), "content_hash", "byte_size",
        step.alias("step"), error.alias("error"),
    )


def counts(sources: DataFrame) -> DataFrame:
    """What a decision needs to know of each district's sources."""
    named = sources.where("school_id is not null")
    return named.groupBy("district_id").agg(
        F.count(F.lit(1)).alias("school_count"),
        F.count("url").alias("staged"),
        F.count_if("accepted").alias("files_transformed"),
        F.count_if(~F.col("accepted")).alias("fetch_failures"),
        F.count_if(F.col("roster_digest").isNull()).alias("submission_failures"),
    )


def events(sources: DataFrame) -> DataFrame:
    """``district_id, rank, school_id, type, data``: the ledger events of the sources."""
    named = sources.where("school_id is not null")
    school = F.col("school_id")

    def told(kind: str, rank: int, /, **values: Column):
        return F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("type"),
            payload(kind, school_id=school, **values).alias("data"),
        )

    sent = F.col("roster_digest").isNotNull()
    each = F.array(
        F.when(sent, told("QuerySubmitted", 1, query_file_hash=F.col("roster_digest"))).otherwise(
            told("SourceFailed", 1, step=F.lit(SOURCE_SUBMIT), error=F.lit(NO_ROSTER))
        ),
        F.when(
            F.col("fetched"),
            told("RecordsFetched", 2, content_hash=F.col("content_hash"), byte_size=F.col("byte_size")),
        ),
        F.when(
            F.col("error").isNotNull(),
            told("SourceFailed", 3, step=F.col("step"), error=F.col("error")),
        ),
    )
    return (
        named.select("district_id", "school_id", F.explode(F.array_compact(each)).alias("event"))
        .select("district_id", "event.rank", "school_id", "event.type", "event.data")
    )
