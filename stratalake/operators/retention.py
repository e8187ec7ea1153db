"""Raw rows for a week, their totals for a year: days of raw rows age into stored hours, days and months (C-5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.parquet import delete_folder, folders, staged

# how a measure is made from rows and from totals
_FROM_ROWS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_FROM_TOTALS = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}

Measures = Mapping[str, tuple[str, str]]  # result name to ("count", "sum", "min" or "max", column)


def _same_types(df: DataFrame, measures: Measures) -> DataFrame:
    """Sums of decimals keep one type however often they are added up."""
    types = {n: df.schema[n].dataType for n in measures}
    wide = {n: F.col(n).cast(T.DecimalType(38, t.scale)) for n, t in types.items() if isinstance(t, T.DecimalType)}
    return df.withColumns(wide) if wide else df


def _again(df: DataFrame, by: Sequence[str], measures: Measures) -> DataFrame:
    return _same_types(df.groupBy(*by).agg(*[_FROM_TOTALS[kind](n).alias(n) for n, (kind, _) in measures.items()]), measures)


def rollups(rows: DataFrame, ts: str, keys: Sequence[str], measures: Measures) -> DataFrame:
    """``keys``, ``grain`` (hour, day, month), ``period`` (its start) and ``measures``.

    Rows shrink to hours before the grouping sets copy them. Rows without a time have a NULL period in every grain.
    """
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    hours = rows.groupBy(*keys, hour.alias("_hour")).agg(*[_FROM_ROWS[kind](c).alias(n) for n, (kind, c) in measures.items()])
    hours = hours.withColumns({f"_{g}": F.date_trunc(g, "_hour").cast("timestamp_ntz") for g in ("day", "month")})
    grains = ["_hour", "_day", "_month"]
    grain = F.when(F.grouping("_hour") == 0, "hour").when(F.grouping("_day") == 0, "day").otherwise("month")
    totals = hours.groupingSets([[F.col(k) for k in (*keys, g)] for g in grains], *keys, *grains).agg(
        grain.alias("grain"), *[_FROM_TOTALS[kind](n).alias(n) for n, (kind, _) in measures.items()]
    )
    return _same_types(totals.select(*keys, "grain", F.coalesce(*grains).alias("period"), *measures), measures)


def _signature(columns: Sequence[str]) -> Column:
    key = F.xxhash64(*columns)
    return F.concat_ws(":", F.count(F.lit(1)), F.bit_xor(key), F.sum(F.xxhash64(F.lit(1), key).cast("decimal(38,0)")))


def _days(spark: SparkSession, path: str, before: date) -> list[str]:
    names = [n[len("day=") :] for n in folders(spark, path) if n.startswith("day=2") or n.startswith("day=1")]
    return sorted(d for d in names if date.fromisoformat(d) < before)


def age(
    spark: SparkSession, raw: str, store: str, as_of: date, ts: str, keys: Sequence[str], measures: Measures, raw_days: int = 7
) -> list[str]:
    """Move raw days (folders ``day=…`` of ``raw``) older than ``raw_days`` into the totals at ``store``; the days moved.

    Totals of a day are one partition and carry a signature of the raw rows added last, so a run that was cut off before
    it removed the raw rows adds nothing twice, and rows that arrive for a day already moved are added to it. Months are
    derived from their days. Raw folders go last. A second run finds no old day and writes nothing. The driver sees
    names of days only; rows without a day never age.
    """
    days = _days(spark, raw, as_of - timedelta(days=raw_days))
    if not days:
        return []
    old = spark.read.parquet(raw).where(F.col("day").isin([date.fromisoformat(d) for d in days]))
    signed = old.groupBy("day").agg(_signature([c for c in old.columns if c != "day"]).alias("raw_signature"))
    totals = rollups(old, ts, ["day", *keys], measures).where("grain <> 'month'").join(signed, "day")
    if folders(spark, f"{store}/days"):
        stored = spark.read.parquet(f"{store}/days").where(F.col("day").isin([date.fromisoformat(d) for d in days]))
        known = stored.select("day", F.col("raw_signature").alias("_known")).distinct()
        totals = totals.join(known, "day", "left").where("_known IS NULL OR _known <> raw_signature").drop("_known")
        fresh = staged(totals, "aged")
        stored = stored.drop("raw_signature").join(fresh.select("day", "raw_signature").distinct(), "day")
        by = ["day", "raw_signature", *keys, "grain", "period"]
        totals = staged(_again(fresh.unionByName(stored), by, measures), "aged")  # the folder is read and written
    _overwrite(totals, f"{store}/days", "day")
    month = F.date_trunc("month", "day").cast("date")
    touched = {date.fromisoformat(d).replace(day=1) for d in days}
    per_day = spark.read.parquet(f"{store}/days").where("grain = 'day'").withColumn("month", month).where(F.col("month").isin(list(touched)))
    per_month = _again(per_day.withColumn("period", F.date_trunc("month", "period").cast("timestamp_ntz")), ["month", *keys, "period"], measures)
    _overwrite(per_month.withColumn("grain", F.lit("month")), f"{store}/months", "month")
    for day in days:
        delete_folder(spark, f"{raw}/day={day}")
    return days


def _overwrite(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that ``df`` holds."""
    df.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def expire(spark: SparkSession, store: str, as_of: date, keep_days: int = 365) -> list[str]:
    """Drop totals of days and of whole months older than ``keep_days``; the days dropped."""
    limit = as_of - timedelta(days=keep_days)
    gone = _days(spark, f"{store}/days", limit)
    for day in gone:
        delete_folder(spark, f"{store}/days/day={day}")
    for name in folders(spark, f"{store}/months"):
        if name.startswith("month=") and name[len("month=") :] < str(limit.replace(day=1)):
            delete_folder(spark, f"{store}/months/{name}")
    return gone


def history(spark: SparkSession, raw: str, store: str, ts: str, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Totals per hour, day and month over what has aged and what is still raw."""
    columns = [*keys, "grain", "period", *measures]
    found = rollups(spark.read.parquet(raw), ts, keys, measures).select(*columns)
    for part in ("days", "months"):
        if folders(spark, f"{store}/{part}"):
            found = found.unionByName(spark.read.parquet(f"{store}/{part}").select(*columns))
    return _again(found, [*keys, "grain", "period"], measures)
