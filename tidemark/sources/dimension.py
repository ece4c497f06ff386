"""Source dimension and results listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.schema import CONFIG_SCHEMA, LISTING_SCHEMA


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """District configuration documents."""
    return spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True)


def _required(column: str) -> Column:
    missing = F.concat(F.lit("missing configuration: "), F.lit(column))
    value = F.col(column)
    return F.when(value.isNull(), F.raise_error(missing)).otherwise(value)


def district(config: DataFrame) -> DataFrame:
    """A district's upload identity.  A missing value fails; none is made up."""
    return config.select(
        _required("district.iddis").alias("iddis"),
        _required("api.s3_upload_host").alias("s3_upload_host"),
    )


def schools(config: DataFrame) -> DataFrame:
    """One row per configured school, under the names used here."""
    return config.select(
        _required("district.iddis").alias("district_id"),
        F.explode("schools").alias("school"),
    ).select(
        "district_id",
        F.col("school.name").alias("school_name"),
        F.col("school.classification").alias("classification"),
        F.col("school.id").alias("school_id"),
        F.col("school.email").alias("email_contact"),
        F.col("school.bulk_query_file").alias("query_file"),
    )


def listing_entries(listings: DataFrame, school: str, body: str) -> DataFrame:
    """Entries of per-school JSON arrays, with their place in the array."""
    parsed = F.from_json(body, LISTING_SCHEMA)
    return listings.select(school, F.posexplode(parsed).alias("position", "entry")).select(
        school,
        "position",
        F.col("entry.uploadDateTime").alias("uploaded"),
        F.col("entry.fullVaccineFileUrl").alias("url"),
    )
