"""Text, hash and token expressions."""

from __future__ import annotations

import hashlib
import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fingerprint(text: Column) -> Column:
    """SHA-256 hex digest: content hash and irreversible mask of personal fields (O-7)."""
    return F.sha2(text, 256)


def token_estimate(text: Column) -> Column:
    """A quarter of the character count, rounded down (O-9)."""
    return F.floor(F.length(text) / 4).cast("int")


def embedding_cost(tokens: Column, usd_per_1k: float) -> Column:
    """Price of embedding ``tokens`` tokens, rounded to 8 places (O-14)."""
    return F.round(tokens / F.lit(1000.0) * F.lit(usd_per_1k), 8)


def windows_of(text: Column, size: int, overlap: int = 0) -> Column:
    """Array of windows of ``size`` characters that overlap by ``overlap`` (O-8).

    The text is cut once into steps of ``size - overlap`` characters and every window is its step plus
    the head of the following text, so the work grows linearly with the text however long it is.
    A window that adds nothing after the overlap of the one before it is not emitted.
    """
    step = size - overlap
    if not 0 <= overlap <= step:
        raise ValueError("overlap must lie between 0 and half of size")
    steps = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    if overlap == 0:
        return steps
    heads = F.transform(F.slice(steps, F.lit(2), F.greatest(F.size(steps), F.lit(1))),
                        lambda s: F.substring(s, 1, overlap))
    whole = F.zip_with(steps, heads, lambda s, h: F.concat(s, F.coalesce(h, F.lit(""))))
    last_is_tail = (F.size(steps) > 1) & (F.length(F.element_at(steps, -1)) <= overlap)
    return F.when(last_is_tail, F.slice(whole, F.lit(1), F.size(whole) - 1)).otherwise(whole)


def sentence_windows_of(text: Column, size: int) -> Column:
    """Array of chunks of whole sentences, each as many as fit in ``size`` characters, the last two left for marks (O-8).

    A sentence ends in ``. ! ?``, a closing quote or bracket if there is one, and one blank, or at a line's end. A
    sentence longer than ``size`` is cut. The chunks do not overlap and give the text when put together. One greedy
    match of the text: it goes back at most ``size`` characters for a border, so the work is linear in the text.
    """
    if size < 4:
        raise ValueError("size must be 4 at least")
    return F.regexp_extract_all(text, F.lit(sentence_pattern(size)), F.lit(0))


def sentence_pattern(size: int) -> str:
    """Matches of at most ``size`` characters: the rest of the text, else up to the last border, else anything."""
    return rf"""(?s).{{1,{size}}}\z|.{{0,{size - 3}}}(?:[.!?]["')\]]?[ \t]|\n)|.{{1,{size}}}"""


def strip_html(page: Column) -> Column:
    """Visible text of a page: scripts, styles and comments go, tags become blanks (O-15)."""
    text = F.regexp_replace(page, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    return squeeze_blanks(decode_entities(text))


@F.pandas_udf(T.StringType())
def decode_entities(text: pd.Series) -> pd.Series:
    """Named and numeric character references as characters; no-break spaces become blanks.

    Spark has no built-in for the names of the HTML standard, so Arrow batches go through the standard library.
    """
    return text.map(lambda s: html.unescape(s).replace("\xa0", " "), na_action="ignore")


def squeeze_blanks(text: Column) -> Column:
    """Runs of ASCII white space become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))


@F.pandas_udf(T.StringType())
def normalize_unicode(text: pd.Series) -> pd.Series:
    """NFC form. Spark has no built-in for it, so Arrow batches go through the standard library."""
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def mask_personal(text: Column) -> Column:
    """E-mail addresses and long digit runs become tokens before the text lands (C-4)."""
    masked = F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>")
    return F.regexp_replace(masked, r"\+?[0-9][0-9 .()-]{7,}[0-9]", "<number>")


def keyed_token(value: Column, secret: str) -> Column:
    """Pseudonym that only the holder of ``secret`` can reproduce: HMAC-SHA-256 in hex (C-4).

    Only the two padded keys are literals of the plan, not the secret itself.
    """
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in key)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))), 256)
