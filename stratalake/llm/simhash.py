"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, verified Hamming distance.

Two fingerprints that differ in at most ``bits`` positions agree in at least two of ``bits + 2`` blocks, so
every close pair meets on some pair of blocks and is then verified. A pair of blocks that very many different
fingerprints share is not expanded into pairs: its members meet on their one-bit neighbours instead. Two
fingerprints have a common neighbour if and only if they differ in at most two bits, so that key proves the
distance and each member needs one link to the least member. No link is lost either way.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import components, staged, unused, whole_text

SEED = 42
PAIRED = 16
_CHUNK = 1 << 16


def fingerprint(text: str, words: int = 3) -> int:
    """64 majority bits over the XXH64 of all shingles, as a signed number; 0 for a text without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(words, len(tokens)) - 1
    spans = zip(starts[: len(starts) - last].tolist(), ends[last:].tolist())
    count = len(tokens) - last
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    held: list[bytes] = []
    for a, b in spans:
        held.append(digest(joined[a:b], SEED))
        if len(held) == _CHUNK:
            set_bits += _ones(held)
            held = []
    if held:
        set_bits += _ones(held)
    return int.from_bytes(np.packbits(set_bits * 2 > count).tobytes(), "big", signed=True)


def _ones(digests: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp, text_hash`` of every document, staged: the only pass over the texts."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    text = whole_text()
    return staged(docs.select("doc_id", of(text).alias("fp"), F.xxhash64(text).alias("text_hash")), "simhash")


def _masks(bits: int) -> list[int]:
    edges = [round(i * 64 / (bits + 2)) for i in range(bits + 3)]
    blocks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    values = [x | y for x, y in combinations(blocks, 2)]
    return [v - (1 << 64) if v >= 1 << 63 else v for v in values]


def links(distinct: DataFrame, bits: int = 2, paired: int = PAIRED) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints ``fp`` (distinct) within ``bits`` of each other, 2 at most."""
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    blocks = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("block")) for i, m in enumerate(_masks(bits))]))
    keyed = distinct.select("fp", blocks.alias("k")).select("k.part", "k.block", "fp")
    shared = staged(keyed.groupBy("part", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "blocks")
    members = staged(keyed.join(shared, ["part", "block"]), "members")
    few, many = members.where(F.col("n") <= paired), members.where(F.col("n") > paired)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    pairs = (
        few.select("part", "block", F.col("fp").alias("a"))
        .join(few.select("part", "block", F.col("fp").alias("b")), ["part", "block"])
        .where((F.col("a") < F.col("b")) & close)
        .select("a", "b")
    )
    flips = [F.lit(0).cast("long")] + [F.lit(f - (1 << 64) if f >= 1 << 63 else f) for f in (1 << i for i in range(64))]
    ball = many.select("fp").distinct().select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(f) for f in flips])).alias("near"))
    least = staged(ball.groupBy("near").agg(F.min("fp").alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1").select("near", "m"), "balls")
    stars = ball.join(least, "near").where("fp <> m").select(F.col("fp").alias("a"), F.col("m").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    if bits < 2:  # a shared neighbour only proves two bits: one-bit neighbours hold the other fingerprint itself
        stars = ball.where("fp <> near").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("near"))) <= bits).join(
            many.select(F.col("fp").alias("near")).distinct(), "near", "left_semi"
        ).select(F.col("fp").alias("a"), F.col("near").alias("b"))
    return pairs.unionByName(stars.where(close)).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, paired: int = PAIRED) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` of every row of ``docs`` (``doc_id, text``).

    Fingerprints link at ``bits`` or fewer differing bits; ``component_id`` is the smallest ``doc_id`` that
    links reach, the document itself included. Null and empty texts have fingerprint 0 and link like any
    other. Repeated rows are all returned. A null ``doc_id`` takes part in links but never names a component
    unless the component has no other. Extra columns are ignored; an empty table gives no rows.
    """
    return _rooted(docs, words, bits, paired).drop("root")


def _rooted(docs: DataFrame, words: int, bits: int, paired: int = PAIRED) -> DataFrame:
    """Rows of ``near_duplicates`` with ``root``, the smallest fingerprint of the component."""
    prints = fingerprints(docs, words)
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = components(links(distinct.select("fp"), bits, paired))
    root = F.coalesce("component", "fp").alias("root")
    labelled = staged(distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", root), "roots")
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    names = staged(labelled.join(named, "root").select("fp", "component_id", "root"), "names")
    return prints.join(names, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def hex_fingerprint(column: str = "fp"):
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def keep_one(docs: DataFrame, words: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the row with its smallest ``doc_id``.

    Several rows with that id keep the one with the least text hash; rows repeated as a whole keep one.
    A component without any id keeps the row with the least text hash.
    """
    rows = _rooted(docs, words, bits)
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "fp")
    id_, unknown, hash_, row = (unused(docs, f"_kept_{n}") for n in ("id", "unknown", "hash", "row"))
    kept = staged(
        rows.groupBy("root")
        .agg(F.min(rank).alias("k"))
        .select(F.coalesce("k.doc_id", F.lit(0)).alias(id_), F.col("k.unknown").alias(unknown), F.col("k.text_hash").alias(hash_)),
        "kept",
    )
    keys = [id_, unknown, hash_]
    marked = docs.withColumns({id_: F.coalesce("doc_id", F.lit(0)), unknown: F.col("doc_id").isNull(), hash_: F.xxhash64(whole_text())})
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(hash_))
    return marked.join(kept, keys, "left_semi").withColumn(row, first).where(F.col(row) == 1).select(*docs.columns)
