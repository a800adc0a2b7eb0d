"""Schemas of the records that are read and written. Field names that other programs use are kept as they are."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: An office-holder as extracted; the first five must be there, and not empty.
REQUIRED = ("url", "identifier", "name", "party", "division")
OPTIONAL = ("email", "photo_url", "standing_down")
PERSON = _strings(*REQUIRED, *OPTIONAL)
#: The stored document of an office-holder: keys in alphabetical order.
PERSON_DOCUMENT = _strings("email", "photo_url", "raw_division", "raw_identifier", "raw_name", "raw_party", "standing_down", "url")
#: The body that an office-holder belongs to. The misspelt key is the one on disk.
ORGANISATION = _strings(
    "url", "official_identifier", "organisation_type", "organisation_subtype", "official_name", "common_name", "slug",
    "territory_code", "election_name", "start_date", "end_date", "created",
)
SERVICE = _strings("cms_type", "cms_version", "base_url", "notes")
METADATA = T.StructType(
    [
        T.StructField("everyelectiion_data", ORGANISATION),
        T.StructField("services", T.StructType([T.StructField("councillors", SERVICE)])),
        T.StructField("everyelectiion_data_last_updated", T.StringType()),
        # older documents have the dates at the top
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
    ]
)
#: What a worker says of its run; a payload may be wrapped once more.
_RESULT = [
    T.StructField("council", T.StringType()),
    T.StructField("scraper_type", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("statusCode", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("runlog_s3_key", T.StringType()),
    T.StructField("files_committed", T.LongType()),
]
RUN_RESULT = T.StructType([*_RESULT, T.StructField("Payload", T.StructType(_RESULT))])
RUN_LOG = T.StructType(
    [
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("duration", T.DayTimeIntervalType()),
        T.StructField("log", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
    ]
)
REGISTRY = T.StructType(
    [
        T.StructField("council_id", T.StringType()),
        T.StructField("parent_class", T.StringType()),
        T.StructField("disabled", T.BooleanType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("class_tags", T.ArrayType(T.StringType())),
        T.StructField("http_lib", T.StringType()),
        T.StructField("timeout", T.IntegerType()),
        T.StructField("selectors", T.MapType(T.StringType(), T.StringType())),
        T.StructField("content", T.StringType()),
    ]
)
FAILING = T.StructType([T.StructField("council_id", T.StringType()), T.StructField("latest_run", _strings("log_text"))])
TASK = _strings("scraper_type", "council")
QUEUE_MESSAGE = T.StructType([T.StructField("Records", T.ArrayType(_strings("messageId", "body")))])
LOG_EVENT = T.StructType([T.StructField("timestamp", T.LongType()), T.StructField("message", T.StringType())])
SYNC_STATS = T.StructType(
    [
        T.StructField("council", T.StringType()),
        T.StructField("files_downloaded", T.IntegerType()),
        T.StructField("files_skipped", T.IntegerType()),
        T.StructField("errors", T.IntegerType()),
        T.StructField("total_bytes", T.LongType()),
        T.StructField("skipped", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("dry_run", T.BooleanType()),
        T.StructField("repo_exists", T.BooleanType()),
    ]
)
_PERSONS = T.ArrayType(
    T.StructType(
        [
            *_strings("councillorid", "fullusername", "politicalpartytitle", "email", "photobigurl").fields,
            T.StructField("termsofoffice", T.StructType([T.StructField("termofoffice", T.ArrayType(_strings("enddate")))])),
        ]
    )
)
#: The XML answer of a ward-wise listing.
WARDS_XML = T.StructType(
    [
        T.StructField(
            "wards",
            T.StructType(
                [
                    T.StructField(
                        "ward",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("wardtitle", T.StringType()),
                                    T.StructField("councillors", T.StructType([T.StructField("councillor", _PERSONS)])),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)
