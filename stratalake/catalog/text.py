"""Text, hash and vector expressions on documents, pages and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.derive import CHUNK_SIZE, DOCS_SQL, chunk_embeddings, chunks, raw_documents
from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.functions.text import (
    fingerprint,
    keyed_token,
    mask_personal,
    normalize_unicode,
    sentence_pattern,
    squeeze_blanks,
    strip_html,
    token_estimate,
)
from stratalake.functions.vectors import cosine, l2_norm, normalised
from stratalake.plans.rag import document_chunks
from stratalake.sources.parquet import load

registry = Registry()
query = registry.query


@query(f"""WITH {DOCS_SQL} SELECT chunk_id, doc_id, doc_version_hash, chunk_index, chunk_text, modality, char_count,
  token_estimate, tenant_id, chunk_ts, CAST(chunk_ts AS DATE) AS chunk_date FROM chunks""")
def document_chunk_rows(spark, sf):
    return chunks(spark, sf).drop("embedding_id", "bronze_doc_id", "silver_run_id")


_SENTENCES = sentence_pattern(CHUNK_SIZE).replace("'", "''")


@query(f"""WITH {DOCS_SQL}, whole AS (SELECT doc_id, regexp_extract_all(text, '{_SENTENCES}') AS found FROM docs)
SELECT doc_id || '-' || CAST(i - 1 AS VARCHAR) AS chunk_id, doc_id, CAST(i - 1 AS INTEGER) AS chunk_index, found[i] AS chunk_text,
  CAST(length(found[i]) AS INTEGER) AS char_count
FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM whole)""")
def sentence_chunk_rows(spark, sf):
    cut = document_chunks(raw_documents(spark, sf), CHUNK_SIZE, 0, "run-1", sentences=True)
    return cut.select("chunk_id", "doc_id", "chunk_index", "chunk_text", "char_count")


@query("""SELECT count(*) AS documents, count(*) AS restored, CAST(0 AS BIGINT) AS too_long FROM documents WHERE length(text) > 0""")
def sentence_chunks_restore(spark, sf):
    """Documents whose chunks give the text again, and chunks beyond the size."""
    docs = raw_documents(spark, sf).where(F.length("text") > 0)
    cut = document_chunks(docs, CHUNK_SIZE, 0, "run-1", sentences=True)
    pieces = F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_text")))
    rebuilt = cut.groupBy("doc_id").agg(
        F.sha2(F.array_join(F.transform(pieces, lambda c: c["chunk_text"]), ""), 256).alias("rebuilt"),
        F.any_value("doc_version_hash").alias("doc_hash"),
        F.count_if(F.col("char_count") > CHUNK_SIZE).alias("too_long"),
    )
    return rebuilt.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("rebuilt") == F.col("doc_hash")).alias("restored"), F.sum("too_long").alias("too_long")
    )


@query(f"""WITH {DOCS_SQL} SELECT embedding_id, chunk_id, doc_id, tenant_id, embedding_model, embed_ts, embed_date,
  prompt_tokens, cost_usd FROM embedded""")
def embedding_records(spark, sf):
    return chunk_embeddings(spark, sf).drop(
        "retrieval_hit_count", "avg_relevance_score", "eval_updated_ts", "chunk_silver_run_id"
    )


@query("""SELECT role, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars,
  CAST(sum(length(text) // 4) AS BIGINT) AS tokens FROM conversations GROUP BY role""")
def text_lengths(spark, sf):
    return load(spark, sf, "conversations").groupBy("role").agg(
        F.count(F.lit(1)).alias("turns"),
        F.sum(F.length("text")).alias("chars"),
        F.sum(token_estimate(F.col("text"))).alias("tokens"),
    )


@query("""SELECT sha256(text) AS content_hash, count(*) AS copies, min(doc_id) AS first_doc
FROM documents GROUP BY 1 HAVING count(*) > 1""")
def content_copies(spark, sf):
    hashed = load(spark, sf, "documents").select("doc_id", fingerprint(F.col("text")).alias("content_hash"))
    return (
        hashed.groupBy("content_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc"))
        .where("copies > 1")
    )


_STRIP = r"""regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"""
# the references that occur in the pages, by their characters; an ampersand comes last, with or without semicolon
_ENTITIES = _STRIP
for _name, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&#39;", "''")):
    _ENTITIES = f"replace({_ENTITIES}, '{_name}', '{_char}')"
_ENTITIES = f"regexp_replace({_ENTITIES}, '&amp;?', '&', 'g')"
_PAGE_TEXT = rf"trim(regexp_replace({_ENTITIES}, '[ \t\r\n\f]+', ' ', 'g'))"


@query(f"SELECT page_id, {_PAGE_TEXT} AS text, length({_PAGE_TEXT}) AS n_chars FROM pages")
def page_text(spark, sf):
    text = strip_html(F.col("html"))
    return load(spark, sf, "pages").select("page_id", text.alias("text")).select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars")
    )


@query(r"""SELECT conv_id, turn, nfc_normalize(trim(regexp_replace(text, '[ \t\r\n\f]+', ' ', 'g'))) AS text FROM conversations""")
def normalised_turns(spark, sf):
    return load(spark, sf, "conversations").select(
        "conv_id", "turn", normalize_unicode(squeeze_blanks(F.col("text"))).alias("text")
    )


def _pad(byte: int) -> str:
    return "'" + "".join(f"\\x{b ^ byte:02X}" for b in b"key".ljust(64, b"\0")) + "'::BLOB"


_TOKEN = f"sha256({_pad(0x5C)} || unhex(sha256({_pad(0x36)} || encode(source))))"


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<email>', 'g'),
  '\+?[0-9][0-9 .()-]{7,}[0-9]', '<number>', 'g') AS text, """ + _TOKEN + " AS source_token FROM documents")
def masked_documents(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", mask_personal(F.col("text")).alias("text"), keyed_token(F.col("source"), "key").alias("source_token")
    )


@query("""SELECT vec_id, CAST(round(CAST(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS norm,
  len(embedding) AS dims FROM embeddings""")
def vector_norms(spark, sf):
    return load(spark, sf, "embeddings").select(
        "vec_id",
        rounded(l2_norm(F.col("embedding")), 4).alias("norm"),
        F.size("embedding").cast("long").alias("dims"),
    )


@query("""SELECT label, count(*) AS vectors,
  count(*) FILTER (WHERE abs(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1) > 0.001) AS off_norm,
  0 AS off_after FROM embeddings GROUP BY label""")
def unit_vectors(spark, sf):
    def off(norm):
        return F.count_if(F.abs(norm - 1) > 0.001)

    v = F.col("embedding")
    return load(spark, sf, "embeddings").groupBy("label").agg(
        F.count(F.lit(1)).alias("vectors"),
        off(l2_norm(v)).alias("off_norm"),
        off(l2_norm(normalised(v))).cast("int").alias("off_after"),
    )


@query("""SELECT vec_id, CAST(round(CAST(list_inner_product(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]) /
  (list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) + 1e-9) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS mirror_score FROM embeddings""")
def cosine_scores(spark, sf):
    v = F.col("embedding")
    return load(spark, sf, "embeddings").select("vec_id", rounded(cosine(v, F.reverse(v)), 4).alias("mirror_score"))
