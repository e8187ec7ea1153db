"""Curation: benchmark passages in documents, shards and checkpoints that hold them; change feeds with deletes."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.registry import Registry
from stratalake.operators import contamination, feed, near_copies
from stratalake.sources.parquet import load, staged

registry = Registry()
query = registry.query

# eight shards a source; checkpoint k has read the first 2 k shards of every source
_SHARD = "concat(source, '-', cast(doc_id % 8 AS STRING))"

CONTAMINATION_SQL = r"""
doc_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM benchmark),
doc_grams AS (
  SELECT doc_id, i AS doc_at, array_to_string(words[i:i + 12], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM doc_words)),
item_grams AS (
  SELECT item_id, i AS item_at, array_to_string(words[i:i + 12], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM item_words)),
places AS (SELECT * FROM doc_grams JOIN item_grams USING (gram)),
runs AS (
  SELECT doc_id, item_id, count(*) + 12 AS run
  FROM (SELECT *, doc_at - row_number() OVER (PARTITION BY doc_id, item_id, doc_at - item_at ORDER BY doc_at) AS island FROM places)
  GROUP BY doc_id, item_id, doc_at - item_at, island),
report AS (
  SELECT doc_id, item_id, count(DISTINCT gram) AS shared_grams, any_value(longest) AS longest_run
  FROM places JOIN (SELECT doc_id, item_id, max(run) AS longest FROM runs GROUP BY ALL) USING (doc_id, item_id)
  GROUP BY doc_id, item_id),
sharded AS (SELECT doc_id, source || '-' || CAST(doc_id % 8 AS VARCHAR) AS shard_id, text FROM documents),
hits AS (
  SELECT shard_id, count(DISTINCT doc_id) AS hit_documents, count(DISTINCT item_id) AS hit_items
  FROM sharded JOIN report USING (doc_id) WHERE longest_run >= 20 GROUP BY shard_id),
shards AS (
  SELECT shard_id, count(*) AS documents, coalesce(any_value(hit_documents), 0) AS hit_documents,
    coalesce(any_value(hit_items), 0) AS hit_items, any_value(hit_documents) IS NOT NULL AS reverted
  FROM sharded LEFT JOIN hits USING (shard_id) GROUP BY shard_id)
"""
_LEAST_RUN = 20


def _sharded(spark, sf):
    return load(spark, sf, "documents").withColumn("shard_id", F.expr(_SHARD))


def _report(spark, sf):
    return contamination.contamination(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


def _shards(spark, sf):
    return staged(contamination.shard_report(_sharded(spark, sf), _report(spark, sf), _LEAST_RUN), "shards")


@query(f"WITH {CONTAMINATION_SQL} SELECT * FROM report")
def contamination_report(spark, sf):
    return _report(spark, sf)


@query(f"WITH {CONTAMINATION_SQL} SELECT * FROM shards")
def reverted_shards(spark, sf):
    return _shards(spark, sf)


@query(f"""WITH {CONTAMINATION_SQL} SELECT shard_id, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars
FROM sharded WHERE shard_id NOT IN (SELECT shard_id FROM shards WHERE reverted) GROUP BY shard_id""")
def corrected_corpus(spark, sf):
    kept = contamination.without_reverted(_sharded(spark, sf), _shards(spark, sf))
    return kept.groupBy("shard_id").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars"))


@query(f"""WITH {CONTAMINATION_SQL}, training AS (
  SELECT DISTINCT 'step-' || CAST(k AS VARCHAR) AS checkpoint, shard_id FROM sharded, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE doc_id % 8 < 2 * k)
SELECT checkpoint, count(*) AS shards, count(*) FILTER (WHERE reverted) AS hit_shards,
  CAST(sum(hit_documents) AS BIGINT) AS hit_documents, count(*) FILTER (WHERE reverted) = 0 AS clean
FROM training JOIN shards USING (shard_id) GROUP BY checkpoint""")
def checkpoint_exposure(spark, sf):
    read = F.filter(F.array(*[F.lit(k) for k in (1, 2, 3, 4)]), lambda k: F.col("doc_id") % 8 < 2 * k)
    training = _sharded(spark, sf).select("shard_id", F.explode(read).alias("k")).select("shard_id", F.concat(F.lit("step-"), "k").alias("checkpoint"))
    return contamination.exposed_checkpoints(training, _shards(spark, sf))


# ── change feed ─────────────────────────────────────────────────────────────────────────────────

# up to four changes an order; numbers are not in the order of arrival, and arrival is cut into three batches
_CHANGE_SEQ = "o_orderkey * 7 % 50 + change * 13 % 31 + 1"
_OPERATION = "CASE WHEN (o_orderkey + change) % 5 = 0 THEN 'D' WHEN change = 1 THEN 'I' ELSE 'U' END"
_BATCH = "(o_orderkey + change * 2) % 3"
_CHANGES_SQL = f"""
changes AS (
  SELECT o_orderkey, o_orderstatus || '-' || CAST(change AS VARCHAR) AS o_orderstatus, o_totalprice + change AS o_totalprice,
    {_CHANGE_SEQ} AS change_seq, {_OPERATION} AS operation
  FROM orders, (SELECT unnest([1, 2, 3, 4]) AS change) WHERE o_orderkey % 4 < change),
every AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, 0 AS change_seq, 'I' AS operation FROM orders WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT * FROM changes),
last AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY change_seq DESC) = 1)
"""


def _changes(spark, sf):
    """The feed: rows of ``orders`` as inserts, updates and deletes with the batch in which they arrive."""
    numbered = load(spark, sf, "orders").withColumn("change", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)])))
    return numbered.where("o_orderkey % 4 < change").select(
        "o_orderkey",
        F.concat("o_orderstatus", F.lit("-"), "change").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.col("change")).alias("o_totalprice"),
        F.expr(_CHANGE_SEQ).alias("seq"),
        F.expr(_OPERATION).alias("operation"),
        F.expr(_BATCH).alias("batch"),
    )


def _order_state(spark, sf):
    snapshot = load(spark, sf, "orders").where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice")
    state = feed.initial_state(snapshot)
    arrived = _changes(spark, sf)
    for batch in (2, 0, 1, 0):  # late, and one batch twice
        changes = feed.as_changes(arrived.where(F.col("batch") == batch).drop("batch"), ["o_orderkey"], "seq", "operation")
        state = staged(feed.apply_changes(state, changes, ["o_orderkey"]), "feed-state")
    return state


@query(f"WITH {_CHANGES_SQL} SELECT o_orderkey, o_orderstatus, o_totalprice FROM last WHERE operation <> 'D'")
def cdc_applied(spark, sf):
    return feed.live_rows(_order_state(spark, sf))


@query(f"""WITH {_CHANGES_SQL} SELECT operation = 'D' AS is_deleted, count(*) AS keys, min(change_seq) AS first_seq, max(change_seq) AS last_seq
FROM last WHERE operation <> 'D' OR change_seq >= 40 GROUP BY 1""")
def cdc_tombstones(spark, sf):
    state = feed.without_old_tombstones(_order_state(spark, sf), 40)
    return state.groupBy("is_deleted").agg(
        F.count(F.lit(1)).alias("keys"), F.min("change_seq").alias("first_seq"), F.max("change_seq").alias("last_seq")
    )


# ── near copies ─────────────────────────────────────────────────────────────────────────────────

_LICENCE = "CASE doc_id % 5 WHEN 0 THEN 'MIT' WHEN 1 THEN 'CC-BY' WHEN 2 THEN 'proprietary' WHEN 3 THEN 'MIT' END"
_COPIES_SQL = r"""
worded AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM worded WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y USING (shingle) GROUP BY ALL),
similar_docs AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * n >= 80 * (p.size + q.size - n)),
reach(doc_id, other) AS (
  SELECT a, b FROM similar_docs UNION SELECT reach.doc_id, b FROM reach JOIN similar_docs ON other = a),
grouped AS (
  SELECT doc_id, source, """ + _LICENCE + r""" AS licence, coalesce((SELECT min(other) FROM reach WHERE reach.doc_id = worded.doc_id), doc_id) AS group_id
  FROM worded)
"""


def _copy_groups(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text", "source", F.expr(_LICENCE).alias("licence"))
    return near_copies.groups(docs)


@query(f"WITH RECURSIVE {_COPIES_SQL} SELECT doc_id, group_id FROM grouped")
def near_copy_groups(spark, sf):
    return _copy_groups(spark, sf).select("doc_id", "group_id")


@query(f"""WITH RECURSIVE {_COPIES_SQL} SELECT group_id,
  CASE min(CASE licence WHEN 'proprietary' THEN 1 WHEN 'CC-BY' THEN 3 WHEN 'MIT' THEN 4 ELSE 2 END)
    WHEN 1 THEN 'proprietary' WHEN 2 THEN 'unknown' WHEN 3 THEN 'CC-BY' ELSE 'MIT' END AS licence,
  count(*) AS members, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM grouped GROUP BY group_id""")
def licensed_corpus(spark, sf):
    return near_copies.keep_one(_copy_groups(spark, sf)).withColumn("sources", F.array_join("sources", ","))
