"""Registered queries of the operators, and the SQL they must equal where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.catalog.registry import Registry
from stratalake.llm import chat, collocations, fim, html_main, imi, mixing, order_minhash, packing, quality, sharding, simhash, toxicity, viterbi
from stratalake.llm.common import load

registry = Registry()


@registry.query()
def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imi.search(load(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


@registry.query()
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_pairs(load(spark, sf_dir, "documents"))


@registry.query()
def op3_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@registry.query()
def op4_factorization_machine_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), p AS (
  SELECT *, length('<|' || replace(replace(replace(role, '<', '<.'), '[', '[.'), '|', '|.') || '|>'
                   || replace(replace(text, '<', '<.'), '[', '[.') || '<|/|>') AS chars
  FROM t
), k AS (
  SELECT *, CAST(ceil(chars / 4.0) AS BIGINT) AS tokens, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS n FROM p
), s AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         (n = 0 AND role = 'system') AS opens
  FROM k
), y AS (
  SELECT *, coalesce(max(CASE WHEN opens THEN tokens END) OVER (PARTITION BY conv_id), 0) AS system_tokens,
         coalesce(max(CASE WHEN opens THEN chars END) OVER (PARTITION BY conv_id), 0) AS system_chars
  FROM s
), l AS (
  SELECT *, CAST(floor(greatest(2, 448 - system_tokens) / 2) AS BIGINT) AS stride FROM y
), g AS (
  SELECT *, CASE WHEN tokens > stride THEN 1 ELSE 0 END AS long, CAST(floor(start / stride) AS BIGINT) AS block FROM l
), h AS (
  SELECT *, coalesce(sum(long) OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS longs FROM g
), e AS (
  SELECT *, max(n) OVER w AS last, min(n) OVER w AS first, max(start + tokens) OVER w AS stop, max(n) OVER (PARTITION BY conv_id) AS final
  FROM h WINDOW w AS (PARTITION BY conv_id, longs, long, block)
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256,
       CAST(sum(chars) + sum(CASE WHEN NOT opens AND stop - start <= 64 AND last < final THEN chars ELSE 0 END)
            + sum(CASE WHEN n = first AND n > 0 THEN system_chars ELSE 0 END) AS BIGINT) AS formatted_chars,
       CAST(count(CASE WHEN n = first THEN 1 END) AS BIGINT) AS n_windows
FROM e GROUP BY conv_id
"""


@registry.query(CHAT_SQL)
def op5_budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.windows(turns.unionByName(more)))


@registry.query()
def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(load(spark, sf_dir, "pages"))


@registry.query()
def op7_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@registry.query()
def op8_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@registry.query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.encoded_documents(load(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CASE turn % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w,
         CASE turn % 3 WHEN 0 THEN 0.5 WHEN 1 THEN -0.5 ELSE 0.0 END::DOUBLE AS ramp, 2.0 * source_size AS most
  FROM s
), c AS (
  SELECT *, sum(source_size) OVER () * 1.5 AS wanted,
         coalesce(sum(most) OVER (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY most / w DESC, source DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_w
  FROM w
), l AS (
  SELECT arg_min((wanted - held) / open_w, most / w) AS level FROM c WHERE (wanted - held) / open_w <= most / w
), t AS (
  SELECT c.source, source_size, least(w * level, most) AS target, ramp FROM c, l
), p AS (
  SELECT d.*, t.source_size, t.target, t.ramp, CAST(floor(t.target / nullif(t.source_size, 0)) AS BIGINT) AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY d.turn, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN size > 0 THEN whole + CASE WHEN start + size / 2.0 < target - whole * source_size THEN 1 ELSE 0 END ELSE 0 END AS copies
  FROM p
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, round(target, 3) AS target,
       CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN round(2.0 * done / ((1.0 - ramp) + sqrt((1.0 - ramp) * (1.0 - ramp) + 4.0 * ramp * done)), 9) END AS position
FROM (SELECT *, least((start + size / 2.0) / target, 1.0) AS done FROM q)
"""


@registry.query(MIX_SQL)
def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(load(spark, sf_dir, "documents"))
    placed = plan.withColumn("position", mixing.position_of_copy(F.lit(0))).orderBy(F.col("position").asc_nulls_last(), "doc_id")
    return placed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "copies", "taken", "position")


FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), d AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), s AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s
"""


@registry.query(FIM_SQL)
def op11_fill_in_middle_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.arrange(fim.store(load(spark, sf_dir, "documents"))))


PHRASE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), s AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w
), g AS (
  SELECT lang, m AS size, words[i:i + m - 1] AS words FROM s, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(words)
), f AS (
  SELECT lang, size, array_to_string(words, ' ') AS phrase, words, count(*) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT * FROM f WHERE size >= 2 AND f >= 10
), k AS (
  SELECT lang, phrase, words, size, f AS a, unnest(range(1, size)) AS k FROM c
), x AS (
  SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * k.a * k.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.words[1:k.k], ' ')
         JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.words[k.k + 1:], ' ')
), b AS (
  SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), o AS (
  SELECT lang, array_to_string(words[1:2], ' ') AS phrase, f FROM c WHERE size = 3
  UNION ALL SELECT lang, array_to_string(words[2:3], ' '), f FROM c WHERE size = 3
), h AS (
  SELECT lang, phrase, max(f) AS longer FROM o GROUP BY ALL
)
SELECT b.lang, rank, b.phrase, a, l, r, n.n, score FROM (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE coalesce(100 * longer < 50 * a, true)
) b JOIN n ON n.lang = b.lang WHERE rank <= 2000
"""


@registry.query(PHRASE_SQL)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))


@registry.query()
def op13_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(load(spark, sf_dir, "documents")))
