"""Passages that documents share with benchmark items, and the shards that hold them (C-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.parquet import staged

GRAM = 13
MOST_BITS = 1 << 23
SALTS = 16


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case; a null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def once(value: Column) -> Column:
    """The value from a one-row generator: filters are pushed below a projection and would compute it again."""
    return F.explode(F.array(value))


def _bit(gram: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(size))


def _starts(words: Column, n: int) -> Column:
    """Places at which a gram begins, from 1; none in a text of fewer than ``n`` words."""
    last = F.size(words) - n + 1
    return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def item_grams(items: DataFrame, n: int = GRAM) -> DataFrame:
    """``item_id, item_at, gram`` of every place of every item (``item_id, text``), staged: the small inverted side."""
    worded = items.select("item_id", once(words_of(F.col("text"))).alias("words"))
    placed = worded.select("item_id", "words", F.explode(_starts(F.col("words"), n)).alias("item_at"))
    return staged(placed.select("item_id", "item_at", F.slice("words", F.col("item_at"), n).alias("gram")).distinct(), "item-grams")


def gram_filter(grams: DataFrame, size: int) -> DataFrame:
    """One row, ``bits``: a Bloom filter of one hash over all grams, of ``size`` bits (a multiple of 64)."""
    bit = grams.select(_bit(F.col("gram"), size).alias("bit")).distinct()
    held = bit.groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask")
    )
    every = grams.sparkSession.range(size // 64).select(F.col("id").cast("int").alias("word"))
    dense = every.join(held, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    return dense.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("rows")).select(
        F.transform("rows", lambda r: r["mask"]).alias("bits")
    )


def shared_places(docs: DataFrame, items: DataFrame, n: int = GRAM) -> DataFrame:
    """``doc_id, copy, doc_at, item_id, item_at, gram``: every place where a document repeats ``n`` words of an item.

    ``copy`` tells several texts of one ``doc_id`` apart; rows that repeat as a whole count once. Grams that the
    filter cannot exclude leave their document alone, so the shuffle carries matches and few others. Each item gram
    is there once per salt and each document's grams use one salt, so a passage that many documents share is
    spread over ``SALTS`` groups without a lost pair.
    """
    grams = item_grams(items, n)
    # sixteen bits a gram, up to a megabyte; a fuller filter only lets more grams through to the exact join
    size = min(MOST_BITS, max(64, 1 << (16 * grams.count()).bit_length()))
    bits = gram_filter(grams, size).scalar()
    copy = F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy")
    worded = docs.select("doc_id", copy, F.col("text"), bits.alias("_bits"))
    worded = worded.select("doc_id", "copy", "_bits", once(words_of(F.col("text"))).alias("words"))

    def possible(at: Column) -> Column:
        bit = _bit(F.slice("words", at, n), size)
        return F.getbit(F.get("_bits", (bit / 64).cast("int")), (bit % 64).cast("int")) == 1

    kept = worded.select("doc_id", "copy", "words", once(F.filter(_starts(F.col("words"), n), possible)).alias("places"))
    placed = kept.select("doc_id", "copy", "words", F.explode("places").alias("doc_at"))
    doc_side = placed.select(
        "doc_id", "copy", "doc_at", F.slice("words", F.col("doc_at"), n).alias("gram"), F.pmod(F.xxhash64("doc_id", "copy"), F.lit(SALTS)).alias("salt")
    ).distinct()
    item_side = grams.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return doc_side.join(item_side, ["gram", "salt"]).drop("salt")


def contamination(docs: DataFrame, items: DataFrame, n: int = GRAM) -> DataFrame:
    """``doc_id, item_id, shared_grams, longest_run`` of every document and item that share ``n`` words in a row.

    ``shared_grams`` counts different grams, ``longest_run`` the words of the longest passage that both hold in the
    same order, found by merging matches that advance in both texts together. If several texts have one ``doc_id``
    the larger figures count; null ids are one document. Texts and items of fewer than ``n`` words match nothing; null and
    empty ones neither. Extra columns are ignored.
    """
    found = staged(shared_places(docs, items, n), "shared")
    text = ["doc_id", "copy", "item_id"]
    shared = found.groupBy(*text).agg(F.count_distinct("gram").alias("shared_grams"))
    line = [*text, "shift"]
    placed = found.withColumn("shift", F.col("doc_at") - F.col("item_at")).drop("gram")
    island = F.col("doc_at") - F.row_number().over(Window.partitionBy(*line).orderBy("doc_at"))
    runs = placed.withColumn("island", island).groupBy(*line, "island").agg((F.count(F.lit(1)) + (n - 1)).alias("run"))
    longest = runs.groupBy(*text).agg(F.max("run").alias("longest_run"))
    both = shared.withColumn("longest_run", F.lit(None).cast("long")).unionByName(longest.withColumn("shared_grams", F.lit(None).cast("long")))
    return both.groupBy("doc_id", "item_id").agg(F.max("shared_grams").alias("shared_grams"), F.max("longest_run").alias("longest_run"))


def shard_report(docs: DataFrame, report: DataFrame, least_run: int = GRAM) -> DataFrame:
    """``shard_id, documents, hit_documents, hit_items, reverted`` of every shard of ``docs`` (``doc_id, shard_id``).

    A shard is reverted if one of its documents shares a passage of ``least_run`` words with an item.
    """
    hits = report.where(F.col("longest_run") >= least_run)
    named = docs.select("shard_id", "doc_id").join(hits.select("doc_id", "item_id"), "doc_id")
    held = named.groupBy("shard_id").agg(F.count_distinct("doc_id").alias("hit_documents"), F.count_distinct("item_id").alias("hit_items"))
    counted = docs.groupBy("shard_id").agg(F.count(F.lit(1)).alias("documents"))
    none = F.lit(0).cast("long")
    return counted.join(held, "shard_id", "left").select(
        "shard_id", "documents", F.coalesce("hit_documents", none).alias("hit_documents"),
        F.coalesce("hit_items", none).alias("hit_items"), F.col("hit_documents").isNotNull().alias("reverted"),
    )


def without_reverted(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """The corrected corpus: rows of ``docs`` whose shard is not reverted; rows without a shard stay."""
    return docs.join(shards.where("reverted").select("shard_id"), "shard_id", "left_anti")


def exposed_checkpoints(training: DataFrame, shards: DataFrame) -> DataFrame:
    """``checkpoint, shards, hit_shards, hit_documents, clean``: what each checkpoint was trained on.

    ``training`` holds ``checkpoint, shard_id``; repeated rows count once.
    """
    known = training.select("checkpoint", "shard_id").distinct().join(shards, "shard_id")
    return known.groupBy("checkpoint").agg(
        F.count(F.lit(1)).alias("shards"),
        F.count_if("reverted").alias("hit_shards"),
        F.sum("hit_documents").alias("hit_documents"),
        (F.count_if("reverted") == 0).alias("clean"),
    )
