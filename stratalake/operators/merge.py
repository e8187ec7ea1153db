"""Row changes as pure DataFrame functions: upsert, delete, version diff.

The target joins the source from the left and the new rows come from an anti join, instead of one
full outer join: adaptive execution can split a skewed target key in a left join, not in a full outer
one. The anti join runs against the distinct target keys, so a hot key arrives as one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import first_per_key

ACTION = "_action"
_HIT = "_hit"


class DuplicateSourceKey(ValueError):
    """The source of a merge holds a key more than once."""


def _keyed(df: DataFrame, on: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def _checked_source(
    source: DataFrame, on: Sequence[str], on_duplicate: str, order_by: Sequence[str | Column]
) -> DataFrame:
    """Source with the marker column, unique on its keys.

    ``error`` counts the keys inside the same plan and raises while the rows are joined; ``latest``
    keeps the first row in the given order; ``trust`` skips the check for sources unique by design.
    """
    if on_duplicate == "latest":
        return first_per_key(source, on, order_by).withColumn(_HIT, F.lit(True))
    if on_duplicate == "trust":
        return source.withColumn(_HIT, F.lit(True))
    if on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error', 'latest' or 'trust', got {on_duplicate!r}")
    # repeated keys alone: none as a rule, so the source is not sorted once more to meet them
    copies = _keyed(source, on).groupBy(*on).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    marker = F.when(
        F.col("_copies") > 1, F.raise_error(F.lit("merge source holds a key more than once")).cast("boolean")
    ).otherwise(F.lit(True))
    return source.join(copies, list(on), "left").withColumn(_HIT, marker).drop("_copies")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: str | Mapping[str, Column] | None = "all",
    not_matched: str | None = "insert",
    condition: Column | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str | Column] = (),
    keep_action: bool = False,
    packed: bool = False,
) -> DataFrame:
    """Target after the merge (T-1 to T-4).

    ``matched="all"`` replaces every column the source has; a mapping sets the listed columns, with
    ``t.`` and ``s.`` naming the two sides; ``None`` leaves matched rows alone. ``not_matched=None``
    inserts nothing. ``condition`` limits the update to matched rows for which it holds. NULL keys
    never match. ``keep_action`` adds ``_action``: update, copy or insert.

    The search for new rows keeps to ``spark.sql.shuffle.partitions``: adaptive execution packs tasks by
    shuffled bytes, and bare keys take many times those in the task that sorts them. ``packed`` lets it pack
    them, for few rows; ``latest`` always does, as its source is shuffled by key already.
    """
    on = list(on)
    src = _checked_source(source, on, on_duplicate, order_by)
    if matched == "all":
        changes = {c: F.col(f"s.{c}") for c in source.columns if c in target.columns and c not in on}
    else:
        changes = dict(matched or {})
    unknown = [c for c in changes if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in target: {unknown}")

    update = F.coalesce(F.col(f"s.{_HIT}"), F.lit(False))
    if condition is not None:
        update = update & F.coalesce(condition, F.lit(False))
    keys_equal = [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on]
    kept = target.alias("t").join(_keyed(src, on).alias("s"), keys_equal, "left")
    kept = kept.select(
        *[
            F.when(update, changes[c].cast(target.schema[c].dataType)).otherwise(F.col(f"t.{c}")).alias(c)
            if c in changes
            else F.col(f"t.{c}").alias(c)
            for c in target.columns
        ],
        F.when(update, "update").otherwise("copy").alias(ACTION),
    )
    result = kept
    if not_matched == "insert":
        seen = _keyed(target.select(*on), on).distinct()
        if not packed and on_duplicate != "latest":
            parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            src = _checked_source(source.repartition(parts, *on), on, on_duplicate, order_by)
        fresh = src.join(seen, on, "left_anti").where(F.col(_HIT))
        fresh = fresh.select(
            *[
                (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
                for c in target.columns
            ],
            F.lit("insert").alias(ACTION),
        )
        result = kept.unionByName(fresh)
    elif not_matched is not None:
        raise ValueError(f"not_matched must be 'insert' or None, got {not_matched!r}")
    return result if keep_action else result.drop(ACTION)


def merge_counts() -> list[Column]:
    """Rows updated, inserted, copied and written by a merge run with ``keep_action``, as aggregates."""
    done = F.col(ACTION)
    return [
        F.count_if(done == "update").alias("rows_updated"),
        F.count_if(done == "insert").alias("rows_inserted"),
        F.count_if(done == "copy").alias("rows_copied"),
        F.count(F.lit(1)).alias("rows_written"),
    ]


def merge_metrics(merged: DataFrame) -> DataFrame:
    """The counts of a merge as one row (T-5)."""
    return merged.agg(*merge_counts())


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which ``predicate`` does not hold; an unknown result keeps the row (T-6)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def version_diff(
    before: DataFrame,
    after: DataFrame,
    on: Sequence[str],
    column: str,
    include_added_removed: bool = False,
) -> DataFrame:
    """Keys whose value of ``column`` differs between two versions, with the difference (T-11, J-6).

    NULL and NaN equal themselves. Keys on one side only are reported on request.
    """
    on = list(on)
    old, new = f"{column}_before", f"{column}_after"
    b = before.select(*on, F.col(column).alias(old), F.lit(True).alias("_was"))
    a = after.select(*on, F.col(column).alias(new), F.lit(True).alias("_is"))
    both = b.join(a, on, "full" if include_added_removed else "inner")
    changed = ~F.col(old).eqNullSafe(F.col(new))
    if include_added_removed:
        changed = changed | F.col("_was").isNull() | F.col("_is").isNull()
    out = both.where(changed)
    columns = [*on, old, new]
    if before.schema[column].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        out = out.withColumn("delta", F.col(new) - F.col(old))
        columns.append("delta")
    if include_added_removed:
        kind = F.when(F.col("_was").isNull(), "added").when(F.col("_is").isNull(), "removed").otherwise("changed")
        out = out.withColumn("change", kind)
        columns.append("change")
    return out.select(*columns)
