"""Token validity, effective permissions and revocation housekeeping as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.blocks import salted_join
from logharbor.functions.timestamps import as_timestamp

# The shipped roles and their permissions.
ROLES = {
    "connector-admin": (
        "monitor:read", "monitor:write", "metrics:read", "metrics:write", "credential:rotate",
        "config:update", "failed_batches:read", "failed_batches:reprocess",
    ),
    "connector-reader": ("monitor:read", "metrics:read", "failed_batches:read"),
}


def permissions_of(role: Column, roles: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Permissions of a role as an array, empty for an unknown role."""
    entries = F.create_map(
        *[
            c
            for name, granted in (roles or ROLES).items()
            for c in (F.lit(name), F.array(*[F.lit(p) for p in granted]))
        ]
    )
    return F.coalesce(F.try_element_at(entries, role), F.array().cast("array<string>"))


def effective_permissions(users: DataFrame, roles=None) -> DataFrame:
    """(username, permission) of active users; `users` has username, roles (array) and active."""
    granted = F.array_distinct(F.flatten(F.transform("roles", lambda r: permissions_of(r, roles))))
    return users.where("active").select("username", F.explode(granted).alias("permission"))


def unauthorised_access(log: DataFrame, users: DataFrame, spread: list[str], roles=None) -> DataFrame:
    """Access rows whose user is unknown, inactive or lacks the permission used.

    The log is joined once on the user with the granted list; a user with very many rows is spread.
    """
    granted = F.array_distinct(F.flatten(F.transform("roles", lambda r: permissions_of(r, roles))))
    grants = users.where("active").select("username", granted.alias("_granted"))
    joined = salted_join(log, grants, ["username"], "left", spread)
    allowed = F.coalesce(F.array_contains("_granted", F.col("permission")), F.lit(False))
    return joined.where(~allowed).drop("_granted")


def token_report(
    tokens: DataFrame, users: DataFrame, revoked: DataFrame, cutoffs: DataFrame, spread: list[str]
) -> DataFrame:
    """Each token with its verdict, in the order user, token id, user-level cutoff.

    Token ids are unique, so that join cannot skew; users and cutoffs are joined as one table keyed
    by user, with the large users spread.
    """
    people = users.select("username", "active").join(cutoffs, "username", "full_outer")
    known = salted_join(tokens, people, ["username"], "left", spread)
    marked = known.join(revoked.select("jti", F.lit(True).alias("_revoked")), "jti", "left")
    verdict = (
        F.when(~F.coalesce("active", F.lit(False)), "invalid_user")
        .when(F.col("_revoked"), "token_revoked")
        .when(F.date_trunc("second", "issued_at") < F.col("revoked_at"), "user_revoked")
        .otherwise("valid")
    )
    return marked.select("jti", "username", "issued_at", verdict.alias("verdict"))


def expired_revocations(revoked: DataFrame, as_of) -> DataFrame:
    """Revocations whose token has expired and that may be forgotten."""
    return revoked.where(F.col("expires_at") < as_timestamp(as_of))


def revocation_stats(revoked: DataFrame, cutoffs: DataFrame, as_of) -> DataFrame:
    """One row: revoked tokens, expired ones among them, and users with a cutoff."""
    tokens = revoked.agg(
        F.count("*").alias("total_revoked_tokens"),
        F.count("expires_at").alias("tracked_expiries"),
        F.count_if(F.col("expires_at") < as_timestamp(as_of)).alias("expired_revocations"),
    )
    users = cutoffs.agg(F.count("*").alias("users_with_revocations"))
    return tokens.withColumn("users_with_revocations", users.scalar())
