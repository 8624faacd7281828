"""Row filtering by user entitlements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.local import local_frame
from ..schemas import struct

ALL = "*"


def entitlements_from_groups(
    memberships: DataFrame, *, admin_group: str, prefix: str, privileged: Sequence[str] = ()
) -> DataFrame:
    """(user, group) rows to (user, scope): the admin group and privileged users see all sources.

    Privileged users need no group.
    """
    user, group = F.col("user"), F.col("group")
    scope = F.when(group == admin_group, F.lit(ALL)).when(
        group.startswith(prefix), F.substring(group, len(prefix) + 1, 1_000_000)
    )
    granted = memberships.select("user", scope.alias("scope")).filter(F.col("scope").isNotNull())
    named = local_frame(memberships.sparkSession, [(name, ALL) for name in privileged], struct("user string, scope string"))
    own = granted.join(named.select("user"), "user", "left_anti")
    return own.unionByName(named).distinct()


def row_filter(df: DataFrame, entitlements: DataFrame, user: str, key: str = "source_country") -> DataFrame:
    """Rows that a user may see: those whose lower-cased key is one of the user's scopes, or all with scope ``*``.

    A NULL key is visible only to ``*``. The user's scopes are one value of a scalar
    subquery, so the filter needs no join and can prune partitions.
    """
    own = entitlements.filter(F.col("user") == user).agg(F.collect_set("scope").alias("scopes"))
    scopes = own.scalar()
    everything = F.array_contains(scopes, F.lit(ALL))
    return df.filter(everything | F.coalesce(F.array_contains(scopes, F.lower(F.col(f"`{key}`"))), F.lit(False)))
