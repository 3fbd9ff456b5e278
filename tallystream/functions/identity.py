"""Who did it and where it goes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def actor_id(user_id: Column | str = "user_id", pseudo_id: Column | str = "user_pseudo_id") -> Column:
    """Signed-in id, else the anonymous one. Blank counts as not signed in."""
    user = F.col(user_id) if isinstance(user_id, str) else user_id
    pseudo = F.col(pseudo_id) if isinstance(pseudo_id, str) else pseudo_id
    return F.coalesce(F.nullif(user, F.lit("")), pseudo)


def ip_hash(ip: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}:"), ip), 256)


def route_subject(prefix: str, app_id: Column) -> Column:
    return F.concat(F.lit(f"{prefix}."), F.replace(F.trim(app_id), F.lit(" "), F.lit("_")))


def message_id(app_id: Column, event_id: Column) -> Column:
    return F.concat(app_id, F.lit(":"), event_id)
