"""Sessions: of actors, by gaps of inactivity, and by the client's own session id.

An actor's events belong to one session as long as each comes less than `gap` seconds after the one
before it. Sessions are built from parts. A part is a stretch of one actor's events within one
slice of time; parts of any set of rows can be merged with those of any other, in any order, into
the parts of both. So the same code builds sessions of a table in one go, of each micro-batch's
rows, and of what many micro-batches left behind, with rows as late as they may be.

Shape of the job. Rows are folded to one per (actor, second), combined map-side, which bounds what an
actor can send; parts are cut per (actor, slice), so an actor with a third of all rows is spread over
as many tasks as there are slices; joining an actor's parts to sessions sees at most a slice's
length / gap parts of each slice.

Cases: rows without an event time or an actor belong to no session; a blank actor is an actor like any other;
equal times are ordered by event name, so first and last names do not depend on the rows' order; copies of a row
count as events each; an empty table has no sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.functions.identity import actor_id

SESSION_GAP_SECONDS = 1800
SLICE_SECONDS = 86_400
OWNER = ["app_id", "environment", "actor_id"]
PARTS = (
    "app_id string, environment string, actor_id string, slice bigint, "
    "opened struct<at:timestamp,name:string>, closed struct<at:timestamp,name:string>, events bigint"
)


def session_parts(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Parts of the sessions in serving rows; columns as in PARTS."""
    _check_gap(gap_seconds)
    second = F.unix_timestamp("event_time")
    moment = F.struct(F.col("event_time").alias("at"), F.col("event_name").alias("name"))
    # No gap is shorter than a second, so a second's events are always together.
    seconds = (
        events.where("event_time is not null")
        .select("app_id", "environment", actor_id().alias("actor_id"), second.alias("second"), moment.alias("moment"))
        .where("actor_id is not null")
        .groupBy(*OWNER, "second")
        .agg(F.min("moment").alias("opened"), F.max("moment").alias("closed"), F.count("*").alias("events"))
    )
    slices = seconds.withColumn("slice", F.floor(F.col("second") / slice_seconds))
    return _joined(slices, [*OWNER, "slice"], gap_seconds)


def merge_parts(parts: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """The parts of all rows that these parts are of."""
    return _joined(parts, [*OWNER, "slice"], gap_seconds)


def sessions_of(parts: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per session: its owner, session_start, session_end, events, duration_ms, entry_event and exit_event."""
    joined = _joined(merge_parts(parts, gap_seconds), OWNER, gap_seconds)
    return joined.select(
        *OWNER,
        F.col("opened.at").alias("session_start"),
        F.col("closed.at").alias("session_end"),
        "events",
        (F.unix_millis("closed.at") - F.unix_millis("opened.at")).alias("duration_ms"),
        F.col("opened.name").alias("entry_event"),
        F.col("closed.name").alias("exit_event"),
    )


def actor_sessions(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Sessions of serving rows in one go."""
    return sessions_of(session_parts(events, gap_seconds), gap_seconds)


def session_summary(sessions: DataFrame) -> DataFrame:
    """Per day that sessions start on: sessions, actors, events, sessions of one event, and their lengths."""
    days = sessions.withColumn("session_date", F.to_date("session_start"))
    # One row per actor and day first, so that a day is no group of its own before it is small.
    actors = days.groupBy("session_date", "actor_id").agg(
        F.count("*").alias("sessions"), F.sum("events").alias("events"), F.count_if(F.col("events") == 1).alias("single"),
        F.sum("duration_ms").alias("total_ms"), F.max("duration_ms").alias("longest_ms"))
    return actors.groupBy("session_date").agg(
        F.sum("sessions").alias("sessions"), F.count("*").alias("actors"), F.sum("events").alias("events"),
        F.sum("single").alias("single_event_sessions"), F.sum("total_ms").alias("total_ms"), F.max("longest_ms").alias("longest_ms"))


def client_sessions(events: DataFrame) -> DataFrame:
    """One row per app and session id that the client sent: events, actors, first and last time, duration_ms.
    Rows without one, or with a blank one, belong to none."""
    own = events.where("event_time is not null and session_id <> ''")
    actors = own.groupBy("app_id", "session_id", actor_id().alias("actor_id")).agg(
        F.count("*").alias("events"), F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    whole = actors.groupBy("app_id", "session_id").agg(
        F.sum("events").alias("events"), F.count("actor_id").alias("actors"),
        F.min("lo").alias("session_start"), F.max("hi").alias("session_end"))
    return whole.withColumn("duration_ms", F.unix_millis("session_end") - F.unix_millis("session_start"))


def _check_gap(gap_seconds: int) -> None:
    if gap_seconds < 1:
        raise ValueError("a gap is at least one second")


def _joined(stretches: DataFrame, by: list[str], gap_seconds: int) -> DataFrame:
    """Stretches (opened, closed, events) that lie less than a gap apart, as one each; they may overlap."""
    in_order = Window.partitionBy(*by).orderBy("opened", "closed")
    reach = F.max("closed").over(in_order.rowsBetween(Window.unboundedPreceding, -1))["at"]
    apart = F.unix_millis("opened.at") - F.unix_millis(reach) >= gap_seconds * 1000
    opens = stretches.withColumn("_opens", F.coalesce(apart, F.lit(True)).cast("int"))
    number = F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return opens.withColumn("_number", number).groupBy(*by, "_number").agg(
        F.min("opened").alias("opened"), F.max("closed").alias("closed"), F.sum("events").alias("events")).drop("_number")
