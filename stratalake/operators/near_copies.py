"""Groups of near copies by an exact set-similarity join, and what a group passes on to the row that stays (C-1).

Texts are sets of hashed word shingles. Two sets with a Jaccard similarity of t share one of their first
floor((1 - t) |set|) + 1 shingles in any order of all shingles, so only these prefixes meet, and only where enough of
both sets follows. The order is that of a sketch, the number of shingles in each of ``BUCKETS`` ranges of hashes, rarest
first: it keeps frequent shingles out of the prefixes, while their exact counts would move every shingle through a
shuffle twice. Sets are never stored: they are made again from the texts where they are needed. Only groups are wanted, so pairs inside a group that is known already are never compared: members of
a shingle first meet its hub; after that the members outside a shingle's largest group meet the others. One
large group of near copies costs one comparison a member, and no pair of different groups is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.contamination import once, words_of
from stratalake.sources.parquet import staged

WORDS = 5
PERCENT = 80
BUCKETS = 1 << 18
STRICTEST = ("proprietary", "unknown", "CC-BY", "MIT")


def shingles(found: Column, words: int = WORDS) -> Column:
    """Distinct hashes of all runs of ``words`` of the words ``found``; fewer words are one shingle, none have none."""
    count = F.size(found)
    last = F.greatest(F.lit(1), count - words + 1)
    hashed = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(found, i, words)))
    return F.when(count == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(hashed))


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, label`` of all nodes of the edges ``a, b``: the least node that each one reaches.

    Every round a node takes the least label around it and then that label's own label, so chains shrink by half.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    for _ in range(rounds):
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearest = staged(labels.join(around, "node").select("node", "label", F.least("label", "near").alias("next")), "nearest")
        jump = nearest.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = staged(nearest.join(jump, "next").select("node", "label", F.least("next", "far").alias("next")), "moved")
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.where("label <> next").isEmpty():
            return labels
    raise RuntimeError(f"labels did not settle in {rounds} rounds")


def _sets(nodes: DataFrame, words: int, *kept: str) -> DataFrame:
    """``kept`` columns of ``nodes`` with ``shingles``, of texts that have words."""
    # generators, since an expression within a lambda or below a filter would be computed again and again
    parsed = nodes.select(*kept, once(words_of(F.col("text"))).alias("_words"))
    return parsed.select(*kept, once(shingles(F.col("_words"), words)).alias("shingles")).where(F.size("shingles") > 0)


def _bucket(shingle: Column) -> Column:
    return F.pmod(shingle, F.lit(BUCKETS)).cast("int")


def _frequencies(sets: DataFrame) -> DataFrame:
    """One row, ``steps``: how many shingles fall into each bucket, in steps of a thousandth of a power of two."""
    counted = sets.select(F.explode("shingles").alias("shingle")).groupBy(_bucket(F.col("shingle")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    step = F.least(F.floor(F.log2("n") * 1000), F.lit(32767)).cast("short")
    every = sets.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(counted, "bucket", "left").select("bucket", F.coalesce(step, F.lit(0).cast("short")).alias("step"))
    return dense.agg(F.sort_array(F.collect_list(F.struct("bucket", "step"))).alias("rows")).select(F.transform("rows", lambda r: r["step"]).alias("steps"))


def _prefixes(nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """``shingle, node, size, place``, staged: the rarest shingles of each set, without those of one set.

    ``shingle`` is the bucket's step and 48 bits of the hash, which sorts as the order wants; two that agree in these
    bits only make a pair more to verify.
    """
    sets = _sets(nodes, words, "node", "text").drop("text")
    ranked = sets.withColumn("_steps", _frequencies(sets).scalar())
    ordered = F.transform("shingles", lambda s: F.shiftleft(F.get("_steps", _bucket(s)).cast("long"), 48).bitwiseOR(F.shiftrightunsigned(s, 16)))
    length = F.floor(F.size("shingles") * (100 - percent) / 100).cast("int") + 1
    first = ranked.select("node", F.size("shingles").alias("size"), once(F.slice(F.sort_array(ordered), F.lit(1), length)).alias("_first"))
    placed = first.select("node", "size", F.posexplode("_first").alias("place", "shingle"))
    counted = placed.withColumn("_sets", F.count(F.lit(1)).over(Window.partitionBy("shingle")))
    return staged(counted.where("_sets > 1").select("shingle", "node", "size", "place"), "prefixes")


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """The staged pairs ``a, b`` whose sets are similar enough, from the whole sets."""
    met = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "met")
    texts = nodes.join(met, "node", "left_semi")  # smaller than their sets
    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    for c in ("_a", "_b"):
        both = both.withColumn(c, once(words_of(F.col(c)))).withColumn(c, once(shingles(F.col(c), words)))
    common = F.size(F.array_intersect("_a", "_b"))
    return both.where(100 * common >= percent * (F.size("_a") + F.size("_b") - common)).select("a", "b")


def _near(percent: int) -> Column:
    """Sizes that allow the similarity, and so does what follows the shared shingle if it is the first that they share."""
    sizes = (100 * F.col("size") >= percent * F.col("other_size")) & (100 * F.col("other_size") >= percent * F.col("size"))
    most = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    return sizes & (100 * most >= percent * (F.col("size") + F.col("other_size") - most))


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hub_rounds: int = 1) -> DataFrame:
    """``docs`` (``doc_id, text`` and others) with ``group_id``: the smallest ``doc_id`` that similar texts reach.

    Texts are similar at ``percent`` of 100 of the union of their sets. Equal texts are one node, so copies are never
    compared. Null and empty texts and others without words are groups of their own row; rows that repeat are all
    returned; a group of null ids only has a null ``group_id``. On disk are each text once, the prefixes, and the texts
    of pairs that may be similar; the list of different texts is a small side as long as Spark broadcasts it.
    """
    digest = F.unhex(F.sha2("text", 256))
    held = docs.where("text IS NOT NULL").select("doc_id", "text", digest.alias("_text"), F.monotonically_increasing_id().alias("node"))
    held = staged(held, "texts", compression="zstd")
    same = staged(held.groupBy("_text").agg(F.min("node").alias("node"), F.min("doc_id").alias("least")), "same")
    nodes = held.select("node", "text").join(same.select("node"), "node", "left_semi")
    keyed = _prefixes(nodes, words, percent)
    links = nodes.sparkSession.createDataFrame([], "a long, b long")
    labels = nodes.sparkSession.createDataFrame([], "node long, label long")
    for round_ in range(hub_rounds + 1):
        known = keyed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        by_label = known.groupBy("shingle", "label").agg(
            F.count(F.lit(1)).alias("members"), F.min(F.struct("node", "size", "place")).alias("hub")
        )
        of = Window.partitionBy("shingle").orderBy(F.desc("members"), "label")
        ranked = by_label.withColumn("_rank", F.row_number().over(of)).withColumn("_labels", F.count(F.lit(1)).over(Window.partitionBy("shingle")))
        main = ranked.where("_rank = 1 AND _labels > 1")
        if round_ < hub_rounds:  # every member outside the largest group meets that group's hub
            hub = main.select(
                "shingle", F.col("label").alias("other_label"), F.col("hub.node").alias("other"), F.col("hub.size").alias("other_size"), F.col("hub.place").alias("other_place")
            )
            met = known.join(hub, "shingle")
        else:  # members outside the largest group meet all members of other groups
            others = known.join(main.select("shingle", F.col("label").alias("_main")), "shingle").where("label <> _main").drop("_main")
            all_members = known.select(
                "shingle", F.col("label").alias("other_label"), F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("place").alias("other_place")
            )
            met = others.join(all_members, "shingle")
        pairs = met.where((F.col("label") != F.col("other_label")) & _near(percent))
        pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        links = staged(links.unionByName(_verified(staged(pairs, "pairs"), nodes, percent, words)), "similar")
        labels = connected(links)
    held = same.join(labels, "node", "left")
    shared = held.where("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("_group"))
    alone = held.where("label IS NULL").select("_text", F.col("least").alias("_group"))
    names = staged(alone.unionByName(held.join(shared, "label").select("_text", "_group")), "names")
    wordless = ~F.coalesce(F.lower("text"), F.lit("")).rlike(r"[\p{L}\p{N}]")
    out = docs.withColumn("_text", digest).withColumn("_wordless", wordless).join(names, "_text", "left")
    return out.select(*docs.columns, F.when(F.col("_wordless"), F.col("doc_id")).otherwise(F.col("_group")).alias("group_id"))


def keep_one(grouped: DataFrame, licence: str = "licence", source: str = "source", strictest: tuple[str, ...] = STRICTEST) -> DataFrame:
    """``group_id, licence, members, sources``: the row that stays of each group and what it inherits.

    The strictest licence of the group's rows wins; a tag that is null or not listed counts as ``unknown``.
    ``sources`` are all sources of the group in order, so that each can be asked or taken out later. Partial
    aggregates: the largest group sends a row from each task.
    """
    tag = F.when(F.col(licence).isin(*strictest), F.col(licence)).otherwise("unknown")
    rank = F.array_position(F.array(*[F.lit(t) for t in strictest]), tag)
    return grouped.groupBy("group_id").agg(
        F.element_at(F.array(*[F.lit(t) for t in strictest]), F.min(rank).cast("int")).alias("licence"),
        F.count(F.lit(1)).alias("members"),
        F.array_sort(F.collect_set(source)).alias("sources"),
    )
