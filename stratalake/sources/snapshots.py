"""Versioned tables as plain Parquet folders plus one small commit row per version.

``<table>/data/snap=<n>/[partition=value/]*.parquet`` is written once and never changed;
``<table>/commits`` holds per version the schema and the folders that make it up. Appends add folders,
restores list old ones again, and a merge or delete on a partitioned table rewrites only the partitions
it touches. The commit row is written last, so a reader never sees half a write and a failed write leaves
nothing but an unlisted folder. One writer at a time: there is no conflict detection.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.layout import cluster, coalesce_to_size, file_stats
from stratalake.operators.merge import ACTION, delete_where, merge, merge_counts

COMMITS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("partition_by", T.ArrayType(T.StringType())),
        T.StructField("dirs", T.ArrayType(T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
        T.StructField("batch_id", T.StringType()),
        T.StructField("ranged", T.ArrayType(T.StringType())),
    ]
)


MANY_FILES = 10_000
PACKED_ROWS = 1_000_000


class SchemaMismatch(ValueError):
    """A write does not fit the schema of its table."""


class NoSuchVersion(ValueError):
    """The table has no such version, or its files were vacuumed."""


# ── commits ─────────────────────────────────────────────────────────────────────────────────────


def _at(spark: SparkSession, folder: str):
    """File system and path of a folder; Spark has no calls of its own for single files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names in a folder and whether each is a folder; empty if there is no such folder."""
    fs, path = _at(spark, folder)
    return [(x.getPath().getName(), x.isDirectory()) for x in fs.listStatus(path)] if fs.exists(path) else []


def commits(spark: SparkSession, path: str) -> DataFrame:
    """All commit rows; empty for a table that does not exist."""
    try:
        return spark.read.schema(COMMITS).json(f"{path}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def _commit_row(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """One commit row; its file is found by name, so no other commit is read."""
    names = {name for name, _ in _names(spark, f"{path}/commits") if name.startswith("version=")}
    name = max(names, default=None) if version is None else _commit_name(version)
    if name not in names:
        return None
    fs, file = _at(spark, f"{path}/commits/{name}")
    stream = fs.open(file)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Row(**{f.name: found.get(f.name) for f in COMMITS} | {"ts": datetime.fromisoformat(found["ts"])})


def _commit_name(version: int) -> str:
    return f"version={version:012d}.json"


def _existing(spark: SparkSession, path: str, version: int | None = None) -> Row:
    row = _commit_row(spark, path, version)
    if row is None:
        raise NoSuchVersion(f"{path}: version {version if version is not None else '(latest)'}")
    if version is not None:
        for folder in row.dirs:
            fs, place = _at(spark, f"{path}/data/{folder}")
            if not fs.exists(place):
                raise NoSuchVersion(f"{path}: version {version} was vacuumed")
    return row


def _write_commit(
    spark: SparkSession,
    path: str,
    version: int,
    operation: str,
    schema: T.StructType | None,
    partition_by: Sequence[str],
    dirs: Sequence[str],
    metrics: Mapping[str, int] | None = None,
    batch_id: str | None = None,
    ranged: Sequence[str] = (),
) -> int:
    row = {
        "version": version,
        "ts": datetime.now(timezone.utc).isoformat(),
        "operation": operation,
        "schema_json": json.dumps(_nullable(schema.jsonValue())) if schema is not None else None,
        "partition_by": list(partition_by),
        "dirs": list(dirs),
        "metrics": dict(metrics or {}),
        "batch_id": batch_id,
        "ranged": list(ranged or ()),
    }
    # hidden until it is whole
    fs, file = _at(spark, f"{path}/commits/{_commit_name(version)}")
    _, part = _at(spark, f"{path}/commits/.{_commit_name(version)}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(json.dumps(row).encode()))
    finally:
        stream.close()
    if not fs.rename(part, file):
        raise RuntimeError(f"{path}: version {version} is there already")
    return version


def _nullable(value):
    """Schema JSON with every nullability flag set, so that schemas compare by name and type."""
    if isinstance(value, dict):
        flags = ("nullable", "containsNull", "valueContainsNull")
        return {k: True if k in flags else _nullable(v) for k, v in value.items() if k != "metadata"} | (
            {"metadata": {}} if "metadata" in value else {}
        )
    return [_nullable(v) for v in value] if isinstance(value, list) else value


def _schema(row: Row) -> T.StructType | None:
    return T.StructType.fromJson(json.loads(row.schema_json)) if row.schema_json else None


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    return _nullable(a.jsonValue()) == _nullable(b.jsonValue())


def _fitting_schema(table: T.StructType, new: T.StructType, schema_mode: str | None) -> T.StructType:
    """Schema after the write; raises where the write does not fit (S5 to S7)."""
    if schema_mode == "overwrite":
        return new
    old_types = {f.name: f.dataType for f in table}
    for f in new:
        if f.name in old_types and not _same_type(f.dataType, old_types[f.name]):
            raise SchemaMismatch(f"column {f.name}: table has {old_types[f.name].simpleString()}, "
                                 f"write has {f.dataType.simpleString()}")
    added = [f for f in new if f.name not in old_types]
    missing = sorted(set(old_types) - set(new.names))
    if schema_mode != "merge" and (added or missing):
        raise SchemaMismatch(f"new columns {[f.name for f in added]}, missing columns {missing}; "
                             "pass schema_mode='merge' to evolve the table")
    return T.StructType([*table.fields, *added])


# ── writes ──────────────────────────────────────────────────────────────────────────────────────


def _write_files(
    df: DataFrame, path: str, version: int, partition_by: Sequence[str], files: int | None
) -> list[str]:
    """Write one snapshot folder and return the folders it holds, relative to ``data``.

    A partitioned write is rebalanced on its partition columns: adaptive execution splits a partition
    value that holds most rows and packs small ones, so files come out even.
    """
    if files:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return _write_as_is(df, path, version, partition_by)


def _write_as_is(df: DataFrame, path: str, version: int, partition_by: Sequence[str]) -> list[str]:
    target = f"{path}/data/snap={version}"
    writer = df.write.mode("overwrite")  # a folder of this number can only stem from a failed write
    if not partition_by:
        writer.parquet(target)
        return [f"snap={version}"]
    writer.partitionBy(*partition_by).parquet(target)
    body = T.StructType([f for f in df.schema if f.name not in partition_by])
    listed = df.sparkSession.read.schema(body).parquet(target).select(_folder("_metadata.file_path").alias("d"))
    return sorted(_unescape(r.d) for r in listed.distinct().collect())


def _folder(file: str) -> Column:
    """Folder of a data file, relative to ``data``."""
    return F.regexp_extract(file, r"/data/(snap=[0-9]+(?:/[^/]+)*)/[^/]+$", 1)


def _unescape(folder: str) -> str:
    """File paths come percent-encoded; folder names are wanted as they are on disk."""
    return unquote(folder)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    schema_mode: str | None = None,
    files: int | None = None,
    operation: str | None = None,
    metrics: Mapping[str, int] | None = None,
    batch_id: str | None = None,
) -> int:
    """Write a new version and return its number (S3, S4, S8, S15).

    ``mode`` is overwrite or append. The schema must match the table unless ``schema_mode`` is
    ``merge`` (add columns) or ``overwrite`` (replace the schema). ``files`` fixes the file count. A
    ``batch_id`` that was committed before makes the call a no-op.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")
    spark = df.sparkSession
    head = _commit_row(spark, path)
    if _committed(spark, path, batch_id):
        return head.version
    version = head.version + 1 if head else 0
    schema, kept, ranged = df.schema, [], []
    if head and head.schema_json:
        if mode == "append" and schema_mode == "overwrite":
            raise ValueError("schema_mode='overwrite' needs mode='overwrite'")
        schema = _fitting_schema(_schema(head), df.schema, schema_mode)
        partition_by = partition_by or head.partition_by
        ranged = [c for c in head.ranged or [] if c in schema.names]
        if mode == "append":
            kept = head.dirs
    dirs = _write_files(df, path, version, partition_by, files)
    _write_ranges(spark, path, version, schema, dirs, ranged)
    name = operation or ("APPEND" if mode == "append" else "OVERWRITE")
    return _write_commit(spark, path, version, name, schema, partition_by, [*kept, *dirs], metrics, batch_id, ranged)


def _committed(spark: SparkSession, path: str, batch_id: str | None) -> bool:
    """Whether a batch of that id was written before."""
    return batch_id is not None and bool(commits(spark, path).where(F.col("batch_id") == batch_id).limit(1).count())


def drop_table(spark: SparkSession, path: str) -> int:
    """Empty the table by a commit without folders; history stays (S14)."""
    head = _existing(spark, path)
    return _write_commit(spark, path, head.version + 1, "DROP", None, [], [])


# ── reads ───────────────────────────────────────────────────────────────────────────────────────


def _read_dirs(spark: SparkSession, path: str, schema: T.StructType, dirs: Sequence[str]) -> DataFrame:
    if not dirs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{d}" for d in dirs])


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Latest state, or the state and schema of ``version`` (S1, S2)."""
    row = _existing(spark, path, version)
    schema = _schema(row)
    if schema is None:
        raise NoSuchVersion(f"{path}: the table was dropped")
    return _read_dirs(spark, path, schema, row.dirs).select(*schema.names)


def table_version(spark: SparkSession, path: str) -> int:
    """Number of the latest version (T-10)."""
    return _existing(spark, path).version


def history(spark: SparkSession, path: str) -> DataFrame:
    """Versions, newest first, with operation and metrics (T-9)."""
    return commits(spark, path).select("version", "ts", "operation", "metrics").orderBy(F.desc("version"))


def active_files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Data files of a version with size and rows (S11)."""
    row = _existing(spark, path, version)
    schema = _schema(row) or T.StructType([])
    if not row.dirs:
        return spark.createDataFrame([], "file string, bytes long, rows long")
    return (
        _read_dirs(spark, path, schema, row.dirs)
        .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def table_stats(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row: version, rows, files, bytes, columns (T-13)."""
    row = _existing(spark, path, version)
    names = _schema(row).names if row.schema_json else []
    return active_files(spark, path, row.version).agg(
        F.lit(row.version).alias("version"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count("file").alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.array(*[F.lit(n) for n in names]).alias("columns"),
    )


def layer_summary(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Version, rows and files of several tables, one row each (M-17)."""
    parts = [table_stats(spark, p).drop("columns").withColumn("table", F.lit(n)) for n, p in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table", "version", "rows", "files", "bytes")


def version_counts(spark: SparkSession, path: str, versions: Sequence[int]) -> DataFrame:
    """Row count of each version (T-12)."""
    parts = [
        read_table(spark, path, v).agg(F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(v).cast("long"))
        for v in versions
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("version", "rows")


# ── changes ─────────────────────────────────────────────────────────────────────────────────────


def restore(spark: SparkSession, path: str, version: int) -> int:
    """Make ``version`` current again as a new version; no data is copied (T-8).

    Raises ``NoSuchVersion`` if its files were vacuumed.
    """
    old, head = _existing(spark, path, version), _existing(spark, path)
    return _write_commit(
        spark, path, head.version + 1, "RESTORE", _schema(old), old.partition_by, old.dirs, {"restored": version}, None, old.ranged
    )


def _touched(rows: DataFrame, head: Row) -> tuple[list[str], list[str], int]:
    """Folders of the table that hold any of ``rows``, the other folders, and the number of such rows.

    Only folder names and counts reach the driver, at most one per partition and snapshot.
    """
    hit = {_unescape(r.d): r.n for r in rows.groupBy(_folder("_file").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return [d for d in head.dirs if d in hit], [d for d in head.dirs if d not in hit], sum(hit.values())


def _files_with(table: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Files of the table that hold a key of ``source``.

    Keys travel with a hash of their file, as sorted rows would hold its whole path each; should two files
    share a hash, both are found.
    """
    file = F.col("_metadata.file_path")
    keys = table.select(*on, F.xxhash64(file).alias("_hash"))
    hit = keys.join(source.select(*on), list(on), "left_semi").select("_hash").distinct()
    files = table.select(file.alias("_file")).distinct().withColumn("_hash", F.xxhash64("_file"))
    return files.join(hit, "_hash").select("_file")  # a semi join would move below the distinct and meet every row


def _delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _at(spark, folder)
    fs.delete(path, True)


def _merge_schema(table: T.StructType, source: T.StructType, schema_mode: str | None, matched, not_matched) -> T.StructType:
    """Schema after a merge: types must agree; new and missing columns need ``schema_mode="merge"``.

    With listed assignments the source may have further columns, which they use; without inserts it may
    leave columns out.
    """
    if schema_mode not in (None, "merge"):
        raise ValueError(f"schema_mode must be None or 'merge', got {schema_mode!r}")
    listed = matched is not None and not isinstance(matched, str)
    fields = [f for f in source if not listed or f.name in table.names]
    if not_matched != "insert":
        fields += [f for f in table if f.name not in source.names]
    return _fitting_schema(table, T.StructType(fields), schema_mode)


def merge_table(
    source: DataFrame,
    path: str,
    on: Sequence[str],
    batch_id: str | None = None,
    schema_mode: str | None = None,
    session: SparkSession | None = None,
    **options,
) -> int:
    """``merge`` into the table as a new version; the commit carries the row counts (T-1 to T-5).

    The source is staged beside the table first: it is computed once, and the folder search and the rewrite
    see the same rows even if a lost executor forces a recomputation. Only folders that hold a matched key
    are rewritten; a key-only semi join finds them. The counts are observed while the files are written. The
    source must fit the table's schema unless ``schema_mode`` is ``merge`` (add columns). A ``batch_id`` that
    was committed before makes the call a no-op, which makes streaming retries safe (R-3).

    ``session`` merges what the source's own session has staged. A stateful stream turns adaptive execution off
    in the session of its batches, where no write is rebalanced: every task would leave a file in every partition.
    """
    spark = session or source.sparkSession
    head = _existing(spark, path)
    if _committed(spark, path, batch_id):
        return head.version
    schema = _merge_schema(_schema(head), source.schema, schema_mode, options.get("matched", "all"), options.get("not_matched", "insert"))
    version = head.version + 1
    staging = f"{path}/staging/version={version}"
    source.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(source.schema).parquet(staging)

    rewrite, keep = [], head.dirs
    # a single folder as well: a stream that only inserts would else rewrite its table with every batch
    if head.dirs and not staged.isEmpty():  # a batch of nothing but repeats has no keys to look for
        rewrite, keep, _ = _touched(_files_with(_read_dirs(spark, path, schema, head.dirs), staged, on), head)
    # every matched key lives in a rewritten folder, so a source row without a match there has none at all
    base = _read_dirs(spark, path, schema, rewrite).select(*schema.names)
    if not rewrite and head.partition_by:  # planned as empty: new rows meet no one, and move once, to their partitions
        base = base.limit(0)
    packed = not rewrite or base.count() + staged.count() <= PACKED_ROWS
    merged = merge(base, staged, on, keep_action=True, packed=packed, **options)
    if rewrite:
        seen = Observation()
        written = merged.observe(seen, *merge_counts()).drop(ACTION)
        if not packed and not head.partition_by:  # else every task of the merge leaves a file
            written = written.hint("rebalance", *[F.col(c) for c in on])
        dirs = _write_files(written, path, version, head.partition_by, None)
        counts = seen.get
    else:  # inserts alone, counted by the files' footers; a plan that Spark finds to be empty observes nothing
        dirs = _write_files(merged.drop(ACTION), path, version, head.partition_by, None)
        added = _read_dirs(spark, path, schema, dirs).count()
        counts = {"rows_updated": 0, "rows_inserted": added, "rows_copied": 0, "rows_written": added}
    _write_ranges(spark, path, version, schema, dirs, head.ranged)
    done = _write_commit(
        spark, path, version, "MERGE", schema, head.partition_by, [*keep, *dirs], counts, batch_id, head.ranged
    )
    _delete_folder(spark, staging)
    return done


def delete_rows(spark: SparkSession, path: str, predicate: Column) -> int:
    """Delete rows as a new version; only folders that hold such rows are rewritten (T-6)."""
    head = _existing(spark, path)
    schema = _schema(head)
    hit = _read_dirs(spark, path, schema, head.dirs).where(predicate).select(
        F.col("_metadata.file_path").alias("_file")
    )
    rewrite, keep, deleted = _touched(hit, head)
    version = head.version + 1
    dirs = []
    if rewrite:
        base = _read_dirs(spark, path, schema, rewrite).select(*schema.names)
        dirs = _write_files(delete_where(base, predicate), path, version, head.partition_by, None)
        _write_ranges(spark, path, version, schema, dirs, head.ranged)
    return _write_commit(
        spark, path, version, "DELETE", schema, head.partition_by, [*keep, *dirs], {"rows_deleted": deleted}, None, head.ranged
    )


def erase(
    spark: SparkSession, paths: Sequence[str], predicate: Column, audit_path: str, subject: str, operator: str
) -> DataFrame:
    """Delete the same rows from several tables, drop all old versions and log it (T-7).

    Time travel of the tables ends here: nothing that held the rows stays on disk.
    """
    now = datetime.now(timezone.utc)
    rows = []
    for path in paths:
        version = delete_rows(spark, path, predicate)
        gone = _existing(spark, path, version).metrics["rows_deleted"]
        vacuum(spark, path, retain=timedelta(0), as_of=now + timedelta(days=1), dry_run=False)
        rows.append((now, operator, subject, path, version, gone))
    audit = spark.createDataFrame(
        rows, "ts timestamp, operator string, subject string, path string, version long, rows_deleted long"
    )
    write_table(audit, audit_path, mode="append", operation="AUDIT")
    return audit


def overwrite_partitions(df: DataFrame, path: str) -> int:
    """Replace exactly the partitions that occur in ``df``, keep the others (P-8, C-8)."""
    spark = df.sparkSession
    head = _existing(spark, path)
    if not head.partition_by:
        raise ValueError(f"{path} is not partitioned")
    schema = _fitting_schema(_schema(head), df.schema, None)
    version = head.version + 1
    dirs = _write_files(df, path, version, head.partition_by, None)
    replaced = {d.split("/", 1)[1] for d in dirs}
    keep = [d for d in head.dirs if d.split("/", 1)[1] not in replaced]
    _write_ranges(spark, path, version, schema, dirs, head.ranged)
    return _write_commit(
        spark, path, version, "OVERWRITE PARTITIONS", schema, head.partition_by, [*keep, *dirs], ranged=head.ranged
    )


# ── layout and retention ────────────────────────────────────────────────────────────────────────


def optimize(
    spark: SparkSession,
    path: str,
    target_bytes: int,
    cluster_by: Sequence[str] = (),
    min_files: int = 1,
) -> int:
    """Rewrite the current version into files of about ``target_bytes`` (P-1), clustered if asked (P-2, P-3).

    The file count grows with the table and is at least ``min_files``. Leaves the value ranges of the
    clustered columns beside the version, for ``read_pruned``.
    """
    head = _existing(spark, path)
    stats = table_stats(spark, path).first()
    n = max(min_files, -(-stats.bytes // target_bytes), 1)
    df = _read_dirs(spark, path, _schema(head), head.dirs).select(*_schema(head).names)
    df = cluster(df, cluster_by, n, head.partition_by) if cluster_by else coalesce_to_size(df, n)
    version = head.version + 1
    if head.partition_by and not cluster_by:
        dirs = _write_files(df, path, version, head.partition_by, None)
    else:
        dirs = _write_as_is(df, path, version, head.partition_by)
    ranged = list(cluster_by) or head.ranged
    _write_ranges(spark, path, version, _schema(head), dirs, ranged)
    return _write_commit(
        spark,
        path,
        version,
        "OPTIMIZE",
        _schema(head),
        head.partition_by,
        dirs,
        {"files_before": stats.files},
        ranged=ranged,
    )


def _write_ranges(spark: SparkSession, path: str, version: int, schema: T.StructType, dirs: Sequence[str], cols: Sequence[str] | None) -> None:
    """Keep the value ranges of the new files of a version, for tables that were clustered once."""
    if cols and dirs:
        file_stats(_read_dirs(spark, path, schema, dirs), cols).write.mode("overwrite").parquet(f"{path}/ranges/snap={version}")


def _file_ranges(spark: SparkSession, path: str, cols: Sequence[str], row: Row) -> DataFrame:
    """Ranges of all files of a version: one kept table per snapshot folder that it lists."""
    schema = _schema(row)
    if not row.dirs or not set(cols) <= set(row.ranged or []):
        return file_stats(_read_dirs(spark, path, schema, row.dirs), cols)
    fields = [T.StructField("file", T.StringType()), T.StructField("rows", T.LongType())]
    for c in cols:
        fields += [T.StructField(f"{end}_{c}", schema[c].dataType) for end in ("min", "max")]
    snaps = sorted({d.split("/", 1)[0] for d in row.dirs})
    kept = spark.read.schema(T.StructType(fields)).parquet(*[f"{path}/ranges/{x}" for x in snaps])
    if not any("/" in d for d in row.dirs):
        return kept
    listed = spark.createDataFrame([(d,) for d in row.dirs], "_dir string")  # a merge leaves some folders of a snapshot
    return kept.withColumn("_dir", F.url_decode(F.replace(_folder("file"), F.lit("+"), F.lit("%2B")))).join(listed, "_dir", "left_semi").drop("_dir")


def file_ranges(spark: SparkSession, path: str, cols: Sequence[str], version: int | None = None) -> DataFrame:
    """Rows and min/max of ``cols`` per data file of a version (P-4); kept ranges are reused."""
    return _file_ranges(spark, path, cols, _existing(spark, path, version))


def read_pruned(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Rows with ``column = value``, opening only the files whose range can hold it (P-6)."""
    row = _existing(spark, path)
    schema = _schema(row)
    may = _file_ranges(spark, path, [column], row).where(
        (F.col(f"min_{column}") <= F.lit(value)) & (F.col(f"max_{column}") >= F.lit(value))
    )
    files = [_unescape(r.file) for r in may.select("file").limit(MANY_FILES + 1).collect()]
    if not files:
        return spark.createDataFrame([], schema)
    if len(files) > MANY_FILES:  # too many names for the driver: the value is nearly everywhere
        return read_table(spark, path).where(F.col(column) == F.lit(value))
    found = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*files)
    return found.where(F.col(column) == F.lit(value)).select(*schema.names)


def _vacuumed(spark: SparkSession, path: str, retain: timedelta, as_of: datetime) -> DataFrame:
    rows = commits(spark, path)
    current = _existing(spark, path).version
    return rows.withColumn("_kept", (F.col("ts") >= F.lit(as_of - retain)) | (F.col("version") == current))


def vacuum_candidates(spark: SparkSession, path: str, retain: timedelta, as_of: datetime) -> DataFrame:
    """Folders that no version younger than ``retain`` and not the current one lists (T-14)."""
    marked = _vacuumed(spark, path, retain, as_of).select("_kept", F.explode("dirs").alias("dir"))
    return marked.groupBy("dir").agg(F.max("_kept").alias("kept")).where(~F.col("kept")).select("dir")


def _on_disk(spark: SparkSession, path: str, folder: str = "") -> list[str]:
    """Data folders that hold files, relative to ``data``, whether or not a commit lists them."""
    names = _names(spark, f"{path}/data/{folder}")
    below = [x for name, is_folder in names if is_folder and not name.startswith(("_", ".")) for x in _on_disk(spark, path, f"{folder}/{name}".lstrip("/"))]
    return below if below or not folder else [folder]


def vacuum(
    spark: SparkSession, path: str, retain: timedelta, as_of: datetime | None = None, dry_run: bool = True
) -> list[str]:
    """Folders to delete; deletes them and their file ranges unless ``dry_run`` (T-14).

    All folders on disk count, so what a failed write left goes as well, and so do staged merge sources. Versions
    that list a deleted folder can no longer be read.
    """
    as_of = as_of or datetime.now(timezone.utc)
    kept = _vacuumed(spark, path, retain, as_of).where("_kept").select(F.explode("dirs").alias("d")).distinct()
    kept = {r.d for r in kept.collect()}
    dirs = sorted(d for d in _on_disk(spark, path) if d not in kept)
    if not dry_run:
        snaps = {d.split("/", 1)[0] for d in kept}
        old = [name for name, _ in _names(spark, f"{path}/ranges") if name not in snaps]
        for folder in [f"data/{d}" for d in dirs] + [f"ranges/{n}" for n in old] + ["staging"]:
            _delete_folder(spark, f"{path}/{folder}")
    return dirs
