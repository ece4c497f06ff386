"""Record, ledger and dimension schemas, and the fixed values of the exchange."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, formats and limits of the exchange itself ---------

# A record's identity is the whole tuple.
KEY = ["id_1", "id_2", "vaccine_group", "vaccination_date"]

# Registry extract: pipe separated, header row, these columns by name.
REGISTRY_SEPARATOR = "|"
REGISTRY_COLUMNS = ["id_1", "id_2", "vaccine_group_name", "vaccination_date"]

# Import file: comma separated, no header, first four columns by position.
IMPORT_SEPARATOR = ","
IMPORT_DATE_FORMAT = "MM/dd/yyyy"

# Volume gate: blocked when new > max(GATE_FLOOR, floor(fraction * known)).
GATE_FLOOR = 50
GATE_FRACTION = 0.2

# Rows per file of a rebaseline export.
CHUNK_RECORDS = 10_000

# Days before a delivered file that is still present counts as overdue.
REMINDER_DAYS = 7

# Runs shown by the status report, and the months it looks back.
STATUS_RUNS = 10
STATUS_MONTHS = 2

# What a run does next, the states it ends in, its steps and the names of faults.
ACTION_SUBMIT, ACTION_WAIT, ACTION_COMPUTE = "submit_queries", "awaiting_results", "compute_diff"
ACTION_DELIVER, ACTION_COMMIT, ACTION_FINISH = "deliver_diff", "commit_master", "finish"
SUCCESS, SKIPPED, BLOCKED, FAILED = "success", "skipped", "blocked", "failed"
STEP_RECONCILE, STEP_FETCH, STEP_GATE, STEP_REBASELINE, STEP_READINESS = (
    "reconcile", "fetch", "diff_sanity", "rebaseline", "readiness",
)
NOTHING_STAGED, ALL_FAILED, TOO_LARGE, EMPTY_MASTER = (
    "NoResultsStaged", "AllDownloadsFailed", "SuspiciousDiffVolume", "EmptyMaster",
)
# Why one source of a run gave nothing, by the step it failed at.
SOURCE_SUBMIT, SOURCE_FETCH, SOURCE_PARSE = "submit", "fetch", "transform"
NO_ROSTER, NO_RESULT, NOT_LANDED, REJECTED = (
    "RosterMissing", "NoResult", "ResultNotLanded", "FileRejected",
)

# Ledger events and their payload fields; RunCompleted takes any counts.
EVENT_FIELDS = {
    "RunStarted": ["kind", "trigger"],
    "QuerySubmitted": ["school_id", "query_file_hash"],
    "RecordsFetched": ["school_id", "content_hash", "byte_size"],
    "SourceFailed": ["school_id", "step", "error"],
    "DiffComputed": ["new_count", "total_count", "known_hash", "diff_hash"],
    "Delivered": ["file_name", "target", "remote_id"],
    "MasterCommitted": ["master_hash", "record_count", "snapshot_path"],
    "ImportConfirmed": ["file_name", "how"],
    "RunSkipped": ["reason"],
    "RunCompleted": None,
    "RunFailed": ["step", "error"],
}
# What an event may carry besides: the version a commit was made on, and which
# of several files of one name was imported.
MORE_FIELDS = {"MasterCommitted": ["base"], "ImportConfirmed": ["remote_id"]}
TERMINAL_TYPES = ["RunCompleted", "RunSkipped", "RunFailed"]
NO_TERMINAL = "NO TERMINAL EVENT"
DELIVERY_TARGET = "drive"
CONFIRMED_HOW = "deleted from Drive"

# --- Schemas -----------------------------------------------------------------

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id_1", T.StringType()),
        T.StructField("id_2", T.StringType()),
        T.StructField("vaccine_group", T.StringType()),
        T.StructField("vaccination_date", T.DateType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
    ]
)

# The fields of a district's configuration that anything here reads.
CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("district", T.StructType([T.StructField("iddis", T.StringType())])),
        T.StructField(
            "api",
            T.StructType(
                [
                    T.StructField("s3_upload_host", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "schools",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("id", T.StringType()),
                        T.StructField("classification", T.StringType()),
                        T.StructField("email", T.StringType()),
                        T.StructField("bulk_query_file", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# The fields of a results listing entry that anything here reads.
LISTING_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("schoolId", T.StringType()),
            T.StructField("uploadDateTime", T.LongType()),
            T.StructField("fullVaccineFileUrl", T.StringType()),
            T.StructField("fullVaccineFileName", T.StringType()),
        ]
    )
)
