"""User accounts: login check and unique registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palabre.schemas import USER_LOGIN

PASSWORD = "password"


def login_matches(users: DataFrame, credentials: DataFrame) -> DataFrame:
    """The users named by a matching e-mail and password; NULL matches nothing.

    Repeated credentials are merged before the shuffle.
    """
    tried = credentials.select(*USER_LOGIN.names).dropna().distinct()
    return users.join(tried, USER_LOGIN.names, "left_semi")


def judge_logins(requests: DataFrame, users: DataFrame, key: str = "key") -> DataFrame:
    """``key, right``: for each requester whether any of its credentials is right.

    ``requests`` has the key, ``email`` and ``password``; a NULL in either is wrong, a NULL key
    is a requester like any other. Equal requests are merged before the shuffle.
    """
    tried = requests.select(F.col(key).alias("key"), *USER_LOGIN.names).distinct()
    pairs = tried.select(*USER_LOGIN.names).dropna().distinct()
    known = pairs.join(users.select(*USER_LOGIN.names), USER_LOGIN.names, "left_semi")
    judged = tried.join(known.withColumn("_right", F.lit(True)), USER_LOGIN.names, "left")
    return judged.groupBy("key").agg(F.coalesce(F.bool_or("_right"), F.lit(False)).alias("right"))


def visible_columns(users: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The columns shown to a client: all but the password unless named."""
    return list(columns) if columns else [c for c in users.columns if c != PASSWORD]


def users_if_authenticated(
    users: DataFrame, credentials: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """All users if any of the credentials is right, else no row."""
    shown = [F.col(f"`{c}`") for c in visible_columns(users, columns)]
    return users.select(*shown).filter(login_matches(users, credentials).exists())


def email_key(email: str = "email") -> Column:
    """What makes a registration unique; a missing e-mail counts as ``''``."""
    return F.coalesce(F.col(email), F.lit(""))


def register_unique(
    new: DataFrame,
    existing: DataFrame,
    order_by: Sequence[str] = ("date_inscription",),
    email: str = "email",
) -> DataFrame:
    """The registrations to accept: the first of each e-mail that is not known yet.

    Give ``order_by`` columns that leave no ties. The first row per e-mail is
    picked on the map side already, so one e-mail with very many registrations
    is cut down before the shuffle.
    """
    name = email_key(email)
    first = Window.partitionBy("_email").orderBy(*order_by)
    candidates = (
        new.withColumn("_email", name)
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
    known = existing.select(name.alias("_email")).distinct()
    return candidates.join(known, "_email", "left_anti").select(*new.columns)
