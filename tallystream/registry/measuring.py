"""Filters and query tools over the serving table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.functions.identity import actor_id
from tallystream.operators import filters, funnel, metrics
from tallystream.plans.newest import newest_events
from tallystream.plans.readonly_sql import readonly_sql
from tallystream.registry import register
from tallystream.registry.fixture import SERVING_CTE, events_view, serving_store, ts_text
from tallystream.schemas import BOT_AGENT_PATTERN

NOT_BOT = f"not regexp_matches(lower(coalesce(ingest_user_agent, '')), '{BOT_AGENT_PATTERN}')"
PROD = f"environment = 'prod' and {NOT_BOT}"
STEPS = ["view", "click", "purchase"]
FIRST, LAST = "2024-01-03", "2024-01-27"
DAYS = f"event_date between date '{FIRST}' and date '{LAST}'"
SAMPLE = f"""event_id, app_id, environment, event_name, {ts_text('event_time')}, actor as actor_id,
  session_id, platform, event_params_json, geo_json, ingest_user_agent"""


def _with(select: str) -> str:
    return f"with {SERVING_CTE} {select}"


@register(
    "filter_optional",
    _with("select app_id, environment, event_name, count(*) as n from serving "
          "where app_id = 'app_1' and environment = 'prod' and event_name = 'click' group by all"),
)
def _(spark, sf):
    rows = filters.filter_optional(events_view(spark, sf), "app_1", "prod", "click")
    return rows.groupBy("app_id", "environment", "event_name").agg(F.count("*").alias("n"))


@register(
    "filter_bots",
    _with(f"select event_id, ingest_user_agent, nats_sequence from serving where {NOT_BOT}"),
)
def _(spark, sf):
    return filters.filter_bots(events_view(spark, sf)).select("event_id", "ingest_user_agent", "nats_sequence")


@register(
    "filter_date_range",
    _with(f"select event_id, nats_sequence, {ts_text('event_time')} from serving where {DAYS}"),
)
def _(spark, sf):
    return filters.filter_date_range(events_view(spark, sf), FIRST, LAST).select(
        "event_id", "nats_sequence", "event_time"
    )


@register("sample_columns", _with(f"select {SAMPLE} from serving"))
def _(spark, sf):
    return metrics.sample_columns(events_view(spark, sf))


@register(
    "funnel_step_filter",
    _with("select event_name, count(*) as n from serving where event_name in ('view', 'click', 'purchase') group by 1"),
)
def _(spark, sf):
    rows = filters.filter_steps(events_view(spark, sf), [" view ", "click", "", "purchase"])
    return rows.groupBy("event_name").agg(F.count("*").alias("n"))


@register(
    "actor_id",
    _with("select user_id, user_pseudo_id, actor as actor_id, count(*) as n from serving group by all"),
)
def _(spark, sf):
    rows = events_view(spark, sf).withColumn("actor_id", actor_id())
    return rows.groupBy("user_id", "user_pseudo_id", "actor_id").agg(F.count("*").alias("n"))


@register(
    "table_overview",
    _with(f"""select count(*) as events, count(distinct app_id) as apps,
      count(distinct event_name) as event_names, count(distinct actor) as actors,
      {ts_text('min(event_time)', 'first_event_time')}, {ts_text('max(event_time)', 'last_event_time')}
      from serving where {NOT_BOT}"""),
)
def _(spark, sf):
    return metrics.table_overview(events_view(spark, sf))


CATALOGUE = f"""select event_name, count(*) as events, count(distinct actor) as actors,
  {ts_text('min(event_time)', 'first_event_time')}, {ts_text('max(event_time)', 'last_event_time')}
  from serving where {PROD} group by event_name"""


@register("list_event_names", _with(f"{CATALOGUE} order by events desc, event_name limit 100"))
def _(spark, sf):
    return metrics.list_event_names(events_view(spark, sf))


@register("top_event_names", _with(f"{CATALOGUE} order by events desc, event_name limit 3"))
def _(spark, sf):
    return metrics.list_event_names(events_view(spark, sf), limit=3)


KEY_COUNTS = f"""select key, count(*) as rows_with_key from (
  select unnest(json_keys(event_params_json)) as key from serving
  where {PROD} and coalesce(event_params_json, '') <> '') k group by key"""


@register("discover_json_keys", _with(f"{KEY_COUNTS} order by rows_with_key desc, key limit 100"))
def _(spark, sf):
    return metrics.discover_json_keys(events_view(spark, sf))


@register("top_json_keys", _with(f"{KEY_COUNTS} order by rows_with_key desc, key limit 2"))
def _(spark, sf):
    return metrics.discover_json_keys(events_view(spark, sf), limit=2)


@register(
    "sample_events",
    _with(f"select {SAMPLE} from (select * from serving where {PROD} "
          "order by event_time desc, event_id, nats_sequence limit 50) s"),
)
def _(spark, sf):
    return metrics.sample_events(events_view(spark, sf), limit=500)


@register(
    "sample_newest_days",
    _with(f"select {SAMPLE} from (select * from serving where {PROD} and event_name = 'purchase' "
          "order by event_time desc, event_id, nats_sequence limit 50) s"),
)
def _(spark, sf):
    """The same tool over the last days only."""
    return newest_events(spark, serving_store(spark, sf), limit=50, event_name="purchase")


@register(
    "checked_limit",
    _with(f"select {SAMPLE} from (select * from serving where {PROD} and app_id = 'app_2' "
          "order by event_time desc, event_id, nats_sequence limit 1) s"),
)
def _(spark, sf):
    """A limit below one counts as one."""
    return metrics.sample_events(events_view(spark, sf), app_id="app_2", limit=-5)


@register(
    "result_cap",
    _with("select count(*) as returned from (select event_id from serving limit 500) s"),
)
def _(spark, sf):
    """A free query is cut at the result cap however large its own limit is."""
    events_view(spark, sf).createOrReplaceTempView("events_serving")
    rows = readonly_sql(spark, "select event_id from events_serving limit 100000", limit=100000)
    return rows.agg(F.count("*").alias("returned"))


@register(
    "calculate_dau",
    _with(f"select strftime(event_date, '%Y-%m-%d') as event_date, count(distinct actor) as dau "
          f"from serving where {DAYS} and {PROD} group by 1"),
)
def _(spark, sf):
    return metrics.daily_active_users(events_view(spark, sf), FIRST, LAST)


@register(
    "calculate_dau_active",
    _with(f"select strftime(event_date, '%Y-%m-%d') as event_date, count(distinct actor) as dau "
          f"from serving where {DAYS} and {PROD} and event_name = 'purchase' and app_id = 'app_0' group by 1"),
)
def _(spark, sf):
    return metrics.daily_active_users(
        events_view(spark, sf), FIRST, LAST, app_id="app_0", active_event_name="purchase"
    )


def _funnel_sql(names: list[str], window: int, where: str, levels: bool = False) -> str:
    """Chain self-join: the n-th step no earlier than the one before, within the window of the first."""
    seconds = "cast(floor(epoch(event_time)) as bigint)"
    ctes = [
        f"m as (select actor, {seconds} as s, event_name as n from serving where {where})",
        f"c1 as (select distinct actor, s as s1, s from m where n = '{names[0]}')",
    ]
    for i, name in enumerate(names[1:], start=2):
        ctes.append(
            f"c{i} as (select distinct c.actor, c.s1, m.s from c{i - 1} c join m "
            f"on m.actor = c.actor and m.n = '{name}' and m.s between c.s and c.s1 + {window})"
        )
    if levels:
        steps = "', '".join(sorted(set(names)))
        level = " + ".join(
            f"cast(exists (select 1 from c{i} where c{i}.actor = a.actor) as integer)"
            for i in range(1, len(names) + 1)
        )
        select = f"select actor as actor_id, {level} as funnel_step from (select distinct actor from m where n in ('{steps}')) a"
    else:
        select = "select " + ", ".join(
            f"(select count(distinct actor) from c{i}) as step_{i}_users" for i in range(1, len(names) + 1)
        )
    return f"with {SERVING_CTE}, {', '.join(ctes)} {select}"


@register("calculate_funnel", _funnel_sql(STEPS, 86_400, f"{DAYS} and {PROD}"))
def _(spark, sf):
    return funnel.calculate_funnel(events_view(spark, sf), STEPS, FIRST, LAST)


@register(
    "calculate_funnel_long_window",
    _funnel_sql(["signup", "view", "view", "purchase"], 72 * 3600, f"{DAYS} and {NOT_BOT} and app_id = 'app_1'"),
)
def _(spark, sf):
    return funnel.calculate_funnel(
        events_view(spark, sf), ["signup", "view", "view", "purchase"], FIRST, LAST,
        app_id="app_1", environment=None, window_hours=72,
    )


@register("funnel_levels", _funnel_sql(STEPS, 3600, "true", levels=True))
def _(spark, sf):
    return funnel.funnel_levels(events_view(spark, sf), STEPS, 3600)


@register(
    "readonly_sql",
    _with("select platform, count(*) as n, count(distinct session_id) as sessions from serving group by platform"),
)
def _(spark, sf):
    events_view(spark, sf).createOrReplaceTempView("events_serving")
    return readonly_sql(
        spark,
        "with p as (select platform, session_id from events_serving where event_time is not null) "
        "select platform, count(*) as n, count(distinct session_id) as sessions from p group by platform;",
    )
