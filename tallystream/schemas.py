"""Column contracts of every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: names, order and types of the published contracts ---------
RAW_COLUMNS = [
    "event_id", "app_id", "environment", "event_name", "event_timestamp",
    "received_at", "user_id", "user_pseudo_id", "session_id", "platform",
    "app_version", "os_version", "device_model", "locale", "timezone",
    "event_params_json", "user_properties_json", "traffic_source_json",
    "geo_json", "consent_json", "ingest_request_id", "ingest_user_agent",
    "ingest_ip_hash", "nats_stream", "nats_sequence",
]
RAW_PARTITIONS = ["app_id", "event_date", "hour"]

SERVING_COLUMNS = [
    "event_id", "app_id", "environment", "event_name", "event_time",
    "event_date", "received_time", "user_id", "user_pseudo_id", "session_id",
    "platform", "app_version", "os_version", "device_model", "locale",
    "timezone", "event_params_json", "user_properties_json",
    "traffic_source_json", "geo_json", "consent_json", "ingest_request_id",
    "ingest_user_agent", "ingest_ip_hash", "nats_stream", "nats_sequence",
]
SERVING_SORT = [
    "app_id", "environment", "event_name", "event_date", "user_pseudo_id", "event_time",
]
SAMPLE_COLUMNS = [
    "event_id", "app_id", "environment", "event_name", "event_time", "actor_id", "session_id",
    "platform", "event_params_json", "geo_json", "ingest_user_agent",
]
JSON_COLUMNS = [
    "consent_json", "event_params_json", "geo_json", "traffic_source_json",
    "user_properties_json",
]

REQUIRED_TEXT = ["event_id", "app_id", "event_name"]
CONTEXTS = {
    "user": ["user_id", "user_pseudo_id", "session_id"],
    "device": ["platform", "app_version", "os_version", "device_model", "locale", "timezone"],
    "traffic_source": ["source", "medium", "campaign"],
    "geo": ["country", "country_code", "city", "region", "timezone"],
    "consent": ["analytics_storage", "ads_storage", "personalization"],
    "ingest": ["user_agent", "ip_hash", "ip", "received_at", "request_id"],
}
OPEN_MAPS = ["event_params", "user_properties"]

MAX_REQUEST_BYTES = 1_048_576
MAX_EVENTS_PER_REQUEST = 500
DEDUP_WINDOW_SECONDS = 600
FLUSH_INTERVAL_SECONDS = 60
MAX_FILE_ROWS = 1000
MAX_FILE_BYTES = 4_194_304
MAX_DELIVERIES = 10
MODEL_LOOKBACK_HOURS = 6
MAX_QUERY_ROWS = 500
MAX_QUERY_SECONDS = 30
MAX_SAMPLE_ROWS = 50
BOT_AGENT_PATTERN = "bot|spider|crawler|headless|bytespider|ahrefs|googlebot"

# (column name, JSON column, JSON path, cast, promoted by default)
PROMOTED_FIELDS = [
    ("geo_country_code", "geo_json", "$.country_code", None, True),
    ("geo_country", "geo_json", "$.country", None, False),
    ("geo_city", "geo_json", "$.city", None, False),
    ("geo_region", "geo_json", "$.region", None, False),
    ("geo_timezone", "geo_json", "$.timezone", None, False),
    ("traffic_source", "traffic_source_json", "$.source", None, False),
    ("traffic_medium", "traffic_source_json", "$.medium", None, False),
    ("traffic_campaign", "traffic_source_json", "$.campaign", None, False),
    ("consent_analytics_storage", "consent_json", "$.analytics_storage", None, False),
    ("consent_ads_storage", "consent_json", "$.ads_storage", None, False),
    ("consent_personalization", "consent_json", "$.personalization", None, False),
    ("event_params_product", "event_params_json", "$.product", None, False),
    ("event_params_surface", "event_params_json", "$.surface", None, False),
    ("event_params_source_type", "event_params_json", "$.source_type", None, False),
    ("event_params_schema_version", "event_params_json", "$.schema_version", None, False),
    ("event_params_page", "event_params_json", "$.page", None, False),
    ("event_params_referrer", "event_params_json", "$.referrer", None, False),
    ("event_params_dimensions", "event_params_json", "$.dimensions", None, False),
    ("event_params_result", "event_params_json", "$.result", None, False),
    ("event_params_utm_source", "event_params_json", "$.utm_source", None, False),
    ("event_params_utm_medium", "event_params_json", "$.utm_medium", None, False),
    ("event_params_utm_campaign", "event_params_json", "$.utm_campaign", None, False),
    ("event_params_trigger", "event_params_json", "$.trigger", None, False),
    ("event_params_view", "event_params_json", "$.view", None, False),
    ("event_params_is_pro", "event_params_json", "$.is_pro", "boolean", False),
    ("event_params_has_capture", "event_params_json", "$.has_capture", "boolean", False),
    ("user_properties_plan_tier", "user_properties_json", "$.plan_tier", None, False),
    ("user_properties_ab_group", "user_properties_json", "$.ab_group", None, False),
]
# --- end of fixed values ------------------------------------------------------


def _raw_type(name: str):
    return LongType() if name == "nats_sequence" else StringType()


RAW_SCHEMA = StructType([StructField(c, _raw_type(c)) for c in RAW_COLUMNS])

# How the raw layer reads back: event_date and hour live only in the path, and
# stay text there so that hour 09 does not turn into the number 9.
RAW_STORE_SCHEMA = StructType(
    RAW_SCHEMA.fields + [StructField("event_date", StringType()), StructField("hour", StringType())]
)

_SERVING_TYPES = {
    "event_time": TimestampType(),
    "received_time": TimestampType(),
    "event_date": DateType(),
    "nats_sequence": LongType(),
}
SERVING_SCHEMA = StructType(
    [StructField(c, _SERVING_TYPES.get(c, StringType())) for c in SERVING_COLUMNS]
)
# How the serving table is stored: also the raw hour a row came from, and a digest of its raw row.
SERVING_STORE_SCHEMA = StructType(
    SERVING_SCHEMA.fields + [StructField("load_hour", StringType()), StructField("row_hash", BinaryType())]
)

MESSAGE_SCHEMA = StructType(
    [
        StructField("value", StringType()),
        StructField("stream", StringType()),
        StructField("sequence", StringType()),
        StructField("published_at", TimestampType()),
    ]
)
