"""Reading event times out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted text shapes ---------------------------------------
EXTENDED_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
COMPACT_TIME = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})([.,]\d+)?(Z|[+-]\d{2}(?::?\d{2})?)?$"
COMPACT_MINUTE = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})?(Z|[+-]\d{2}(?::?\d{2})?)?$"
COMPACT_DATE = r"^(\d{4})(\d{2})(\d{2})$"
WEEK_DATE = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"
STRICT_OFFSET_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?[+-]\d{2}:\d{2}$"
EPOCH = r"^\d{9,10}$|^\d{13}$|^\d{16}$"
STAMP = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$"
SLASHES = r"^(\d{4})/(\d{2})/(\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?$"
MAIL_TIME = r"^(?:[A-Z][a-z]{2}, )?(\d{1,2}) ([A-Z][a-z]{2}) (\d{4}) (\d{2}:\d{2}:\d{2}) (?:GMT|UTC|Z|[+-]0000)$"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# --- end of fixed values --------------------------------------------------------


def parse_iso(text: Column) -> Column:
    """ISO 8601 text as a UTC instant; text without a zone is UTC; anything else NULL.

    The shape is checked first because a plain cast would also take a bare year
    or a bare time of day.
    """
    t = F.trim(text)
    extended = F.when(
        t.rlike(EXTENDED_TIME), F.translate(t, ",", ".").try_cast("timestamp")
    )
    compact = F.when(
        t.rlike(COMPACT_TIME),
        F.translate(
            F.regexp_replace(t, COMPACT_TIME, "$1-$2-$3T$4:$5:$6$7$8"), ",", "."
        ).try_cast("timestamp"),
    )
    minute = F.when(
        t.rlike(COMPACT_MINUTE),
        F.regexp_replace(
            F.regexp_replace(t, COMPACT_MINUTE, "$1-$2-$3T$4:$5:00$6"), "T(..)::", "T$1:00:"
        ).try_cast("timestamp"),
    )
    day = F.when(
        t.rlike(COMPACT_DATE),
        F.regexp_replace(t, COMPACT_DATE, "$1-$2-$3").try_cast("timestamp"),
    )
    return F.coalesce(extended, compact, minute, day, _week_day(t))


def _week_day(text: Column) -> Column:
    """Midnight of a week date; its Monday if no day is named."""
    part = lambda i: F.regexp_extract(text, WEEK_DATE, i).try_cast("int")
    monday = F.to_date(F.date_trunc("WEEK", F.make_date(part(1), F.lit(1), F.lit(4)).cast("timestamp")))
    found = F.date_add(monday, (part(2) - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1)
    # Week 53 counts only where the year has one.
    own_week = F.weekofyear(found) == part(2)
    return F.when(text.rlike(WEEK_DATE), F.when(own_week, found.cast("timestamp")))


def parse_best_effort_ms(text: Column) -> Column:
    """Cut to milliseconds: ISO text, epoch digits (9-10 seconds, 13 milliseconds, 16
    microseconds), 14 digits of a stamp, dates with slashes, mail dates in UTC; else NULL."""
    t = F.trim(text)
    number, digits = t.try_cast("bigint"), F.length(t)
    epoch = F.when(
        t.rlike(EPOCH),
        F.when(digits == 16, F.timestamp_micros(number))
        .when(digits == 13, F.timestamp_millis(number))
        .otherwise(F.timestamp_seconds(number)),
    )
    stamp = F.when(t.rlike(STAMP), F.regexp_replace(t, STAMP, "$1-$2-$3 $4:$5:$6").try_cast("timestamp"))
    slashes = F.when(t.rlike(SLASHES), F.trim(F.regexp_replace(t, SLASHES, "$1-$2-$3 $4")).try_cast("timestamp"))
    part = lambda i: F.regexp_extract(t, MAIL_TIME, i)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), part(2))
    mail = F.when(
        t.rlike(MAIL_TIME),
        F.concat(part(3), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0"),
                 F.lit("T"), part(4), F.lit("Z")).try_cast("timestamp"),
    )
    return F.date_trunc("MILLISECOND", F.coalesce(parse_iso(text), epoch, stamp, slashes, mail))


def parse_strict_offset(text: Column) -> Column:
    """Only `yyyy-mm-ddThh:mm:ss[.f]+hh:mm` counts; a bare time or `Z` is NULL."""
    return F.when(text.rlike(STRICT_OFFSET_TIME), text.try_cast("timestamp"))


def event_date_of(event_time: Column) -> Column:
    return F.to_date(event_time)


def event_month_of(event_date: Column) -> Column:
    return F.date_format(event_date, "yyyyMM").cast("int")


def partition_instant(event_timestamp: Column, fallback: Column, now: Column | None = None) -> Column:
    """Event time, else receive time, else `now`."""
    return F.coalesce(
        parse_iso(event_timestamp), parse_iso(fallback), F.current_timestamp() if now is None else now
    )


def partition_date(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd")


def partition_hour(instant: Column) -> Column:
    return F.date_format(instant, "HH")


def iso_offset_text(instant: Column) -> Column:
    """UTC instant as `yyyy-mm-ddThh:mm:ss[.ffffff]+00:00`; no fraction when it is zero."""
    micros = F.date_format(instant, "SSSSSS")
    return F.concat(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
        F.lit("+00:00"),
    )


# --- fixed values: times a client may send, and steps to their one spelling --------
CLIENT_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([Tt _]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?\s?([Zz]|[+-]\d{2}:?\d{2})?)?$"
)
CLIENT_TIME_STEPS = [
    (r"^(.{10})$", "$1T00:00:00"),  # a date is its midnight
    (r"^(.{10}).", "$1T"),  # one separator
    (r"\s", ""),
    (r"^(.{16})(?!:)", "$1:00"),  # seconds always
    (r"\.(\d+)", ".$1000000"),  # six fraction digits ...
    (r"\.(\d{6})\d*", ".$1"),
    (r"\.000000", ""),  # ... or none
    (r"([+-]\d{2})(\d{2})$", "$1:$2"),
    (r"[+-]00:00$", "Z"),
]
# What nearly all clients send.
PLAIN_CLIENT_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$"
CLIENT_EPOCH = r"^[+-]?\d+(\.\d*)?$"
# Numbers beyond this many seconds are milliseconds.
EPOCH_MILLIS_FROM = 20_000_000_000
EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)
# --- end of fixed values ----------------------------------------------------------


def _client_epoch(text: Column) -> Column:
    number = text.try_cast("decimal(30,9)")
    seconds = F.when(F.abs(number) > EPOCH_MILLIS_FROM, number / 1000).otherwise(number)
    return F.when(
        text.rlike(CLIENT_EPOCH) & seconds.between(*EPOCH_RANGE),
        F.timestamp_micros((seconds * 1_000_000).try_cast("bigint")),
    )


def _client_spelling(text: Column) -> Column:
    spelled = F.translate(F.upper(text), ",", ".")
    for pattern, replacement in CLIENT_TIME_STEPS:
        spelled = F.regexp_replace(spelled, pattern, replacement)
    return spelled


def client_time_ok(text: Column) -> Column:
    """True when a client may send this text (or number) as a time."""
    t = F.trim(text)
    return (
        F.when(t.rlike(PLAIN_CLIENT_TIME), t.try_cast("timestamp").isNotNull())
        .when(t.rlike(CLIENT_TIME), _client_spelling(t).try_cast("timestamp").isNotNull())
        .otherwise(_client_epoch(t).isNotNull())
    )


def client_time_text(text: Column) -> Column:
    """The one spelling under which a valid client time travels on.

    Six fraction digits or none, `Z` for UTC, other offsets kept, no zone kept
    as no zone, epoch numbers written as UTC.
    """
    t = F.trim(text)
    digits = F.rpad(F.substr(t, F.lit(21), F.length(t) - 21), 6, "0")
    fraction = F.when((F.length(t) == 20) | (digits == "000000"), "").otherwise(F.concat(F.lit("."), digits))
    return (
        F.when(t.rlike(PLAIN_CLIENT_TIME), F.concat(F.left(t, F.lit(19)), fraction, F.lit("Z")))
        .when(t.rlike(CLIENT_TIME), _client_spelling(t))
        .when(t.rlike(CLIENT_EPOCH), F.regexp_replace(iso_offset_text(_client_epoch(t)), r"\+00:00$", "Z"))
    )
