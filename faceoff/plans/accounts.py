"""User accounts on the keyed ``users`` table (MNT-1 … MNT-6 applied).

The reference's registration and admin screens, re-aimed as set-based jobs
over DataFrames of requests: usernames are normalised (lower-case, no
whitespace — M17), user types and zones are checked against their domains,
passwords may not contain the delimiter (FN-12).  Checks are expressions in
the plan: a bad request fails the job (``raise_error``) or is refused with its
reason, and none is collected and inspected on the driver.  Authentication itself is not built.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.functions.clock import ZONES
from faceoff.functions.text import normalize_key, normalize_key_text, without_separator
from faceoff.operators import tables
from faceoff.operators.choices import USER_TYPES

KEY = "Username"
PUBLIC_COLUMNS = ("Username", "UserType", "Timezone")


def _one_of(c: Column, domain: Iterable[str], what: str) -> Column:
    values = list(domain)
    v = F.lower(F.trim(c))
    return F.when(v.isin(values), v).otherwise(
        F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(c, F.lit("NULL"))))
    )


def _username(c: Column) -> Column:
    key = normalize_key(c)
    return F.when(F.length(key) > 0, key).otherwise(F.raise_error(F.lit("empty username")))


def ensure_users_table(spark: SparkSession, name: str, buckets: int = tables.DEFAULT_BUCKETS) -> None:
    """MNT-6: create the users table on first use."""
    if not tables.table_exists(spark, name):
        tables.create_keyed_table(spark, name, schemas.USERS, KEY, buckets=buckets)


def _fault() -> Column:
    """What is wrong with a request on its own, or NULL."""
    known = lambda c, domain: F.coalesce(F.lower(F.trim(c)).isin(list(domain)), F.lit(False))
    return (
        F.when(~F.coalesce(F.length(normalize_key(F.col("Username"))) > 0, F.lit(False)), "empty username")
        .when(F.contains("Password", F.lit(",")), "separator in password")
        .when(~known(F.col("UserType"), USER_TYPES), "unknown user type")
        .when(~known(F.col("Timezone"), ZONES), "unknown zone")
    )


def register(spark: SparkSession, name: str, requests: DataFrame, order_by: str | None = None,
             on_invalid: str = "fail") -> DataFrame:
    """Add accounts whose normalised username is not taken yet (MNT-1).

    ``requests`` has the users columns.  Of requests for one name the first
    by ``order_by`` counts (ties, or without it: by position in ``requests``).
    Returns the refused requests, without passwords: (Username, UserType,
    Timezone, reason), the reason being ``taken`` (the table had the name) or
    ``repeated`` (an earlier request has it).  A request that is wrong on its own fails the job, or with
    ``on_invalid="refuse"`` is refused like the others, with its fault as the reason (as the screens refuse
    one request and go on); it takes no name.
    """
    if on_invalid not in ("fail", "refuse"):
        raise ValueError("on_invalid must be 'fail' or 'refuse'")
    ensure_users_table(spark, name)
    values = {
        "Username": _username(F.col("Username")),
        "Password": without_separator(F.col("Password"), ",", what="password"),
        "UserType": _one_of(F.col("UserType"), USER_TYPES, "user type"),
        "Timezone": _one_of(F.col("Timezone"), ZONES, "zone"),
    }
    fault = _fault() if on_invalid == "refuse" else F.lit(None).cast("string")
    if on_invalid == "refuse":  # a faulty request stays as it was asked
        values = {c: F.when(fault.isNull(), v).otherwise(F.col(c)) for c, v in values.items()}
    rows = requests.select(
        *[v.alias(c) for c, v in values.items()],
        fault.alias("__fault"),
        F.struct(
            (F.col(order_by) if order_by else F.lit(0)).alias("by"), F.monotonically_increasing_id().alias("row")
        ).alias("__turn"),
    )
    # positions are only the same in every pass if they are written down
    rows = tables.written_once(rows)
    # combined before the shuffle, however often one name is asked for
    first = rows.filter("__fault IS NULL").groupBy("Username").agg(F.min("__turn").alias("__first"))
    taken = tables.lookup_many(spark, name, first.select("Username"), ["Username"]).withColumn("__taken", F.lit(True))
    judged = (
        rows.join(first.join(taken, "Username", "left"), "Username", "left")
        .withColumn("reason", F.when(F.col("__fault").isNotNull(), F.col("__fault")).when(F.col("__taken"), "taken")
                    .when(F.col("__turn") != F.col("__first"), "repeated"))
        .select("Username", "Password", "UserType", "Timezone", "reason")
    )
    judged = tables.written_once(judged)  # before the table changes
    tables.insert_if_absent(spark, name, judged.filter("reason IS NULL").drop("reason"))
    return judged.filter("reason IS NOT NULL").drop("Password")


def set_timezone(spark: SparkSession, name: str, changes: DataFrame) -> None:
    """Change the zone of existing accounts (``Username``, ``Timezone``); absent users are ignored."""
    rows = changes.select(
        _username(F.col("Username")).alias("Username"), _one_of(F.col("Timezone"), ZONES, "zone").alias("Timezone")
    )
    tables.update_by_key(spark, name, rows)


def remove(spark: SparkSession, name: str, usernames: DataFrame) -> None:
    """Delete accounts by username (MNT-3)."""
    tables.delete_by_key(spark, name, usernames.select(_username(F.col("Username")).alias("Username")))


def list_users(spark: SparkSession, name: str) -> DataFrame:
    """All accounts without their passwords (MNT-5)."""
    return spark.table(name).select(*PUBLIC_COLUMNS)


def settings(spark: SparkSession, name: str, username: str) -> DataFrame:
    """User type and zone of one account (MNT-4), a partition-pruned point lookup."""
    return tables.lookup(spark, name, normalize_key_text(username), ["UserType", "Timezone"])


def user_zone(spark: SparkSession, name: str, username: str, default: str = "est") -> str:
    """The zone an account chose for upcoming games (``default`` for an unknown user).

    A point lookup returning at most one row; the value then selects the clock
    column of ``reports.next_games``.
    """
    row = settings(spark, name, username).select("Timezone").limit(1).collect()  # at most one row
    return row[0]["Timezone"] if row and row[0]["Timezone"] else default
