"""Applying a change feed whose changes may come late, twice or out of order (C-3, R-3).

The state keeps one row per key, deleted keys included: the columns of the target, the sequence number of the last
change and whether it was a delete. The later change of a key wins wherever it comes from, so batches may be applied
in any order and any number of times with the same result, and a late change cannot revive a deleted row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import first_per_key
from stratalake.operators.joins import null_safe_join

SEQUENCE, DELETED = "change_seq", "is_deleted"


def initial_state(snapshot: DataFrame, sequence: int = 0) -> DataFrame:
    """State of a snapshot: every row counts as written at ``sequence``."""
    return snapshot.withColumns({SEQUENCE: F.lit(sequence).cast("long"), DELETED: F.lit(False)})


def as_changes(feed: DataFrame, keys: list[str], sequence: str, operation: str) -> DataFrame:
    """The feed as state rows: inserts and updates carry their values, deletes (``D``) only the key.

    Operations are read by their first letter in any case; a row with another one or without a sequence number raises.
    """
    letter = F.upper(F.substring(F.col(operation), 1, 1))
    known = letter.isin("I", "U", "D", "R", "C") & F.col(sequence).isNotNull()  # R, C: snapshot read and create
    checked = F.when(known, letter == "D").otherwise(F.raise_error(F.lit("a change needs a known operation and a sequence number")).cast("boolean"))
    values = [c for c in feed.columns if c not in (*keys, sequence, operation)]
    deleted = feed.withColumn(DELETED, checked)
    return deleted.select(
        *keys, *[F.when(~F.col(DELETED), F.col(c)).alias(c) for c in values], F.col(sequence).cast("long").alias(SEQUENCE), DELETED
    )


def _rank(prefix: str, values: list[str]) -> list[Column]:
    """Order of changes of one key: sequence number, writes before deletes of the same number, then the values' hash."""
    return [F.col(f"{prefix}{SEQUENCE}"), F.col(f"{prefix}{DELETED}"), F.xxhash64(*[F.col(f"{prefix}{c}") for c in values])]


def fold(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of every key; every task keeps one row of a key before the shuffle."""
    values = [c for c in changes.columns if c not in keys]
    return first_per_key(changes, keys, [c.desc() for c in _rank("", values)])


def apply_changes(state: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """State after the changes: matched rows take the later side, unmatched changes are added, also deletes.

    Null keys meet each other; repeated changes count once. Only the folded changes are joined: a left join, which
    adaptive execution may split where a key range is hot, and an anti join on the keys.
    """
    values = [c for c in state.columns if c not in keys]
    if set(changes.columns) != set(state.columns):
        raise ValueError(f"changes have columns {changes.columns}, the state has {state.columns}")
    last = fold(changes, keys)
    joined = null_safe_join(state, last.select(*keys, F.struct(*values).alias("_new")), keys, "left")
    later = F.col("_new").isNotNull() & (F.struct(*_rank("_new.", values)) > F.struct(*_rank("", values)))
    kept = joined.select(*keys, *[F.when(later, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values])
    added = null_safe_join(last, state.select(*keys), keys, "left_anti")
    return kept.unionByName(added)


def live_rows(state: DataFrame) -> DataFrame:
    """The table as readers see it."""
    return state.where(~F.col(DELETED)).drop(SEQUENCE, DELETED)


def without_old_tombstones(state: DataFrame, horizon: int) -> DataFrame:
    """State without deletes below ``horizon``: safe once no change with a lower number can still arrive."""
    return state.where(~F.col(DELETED) | (F.col(SEQUENCE) >= horizon))
