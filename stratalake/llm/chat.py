"""Chat formatting in budgeted windows (DataFrame functions only).

A turn is written ``<|role|>text<|/|>``. In texts and roles a point is put after every ``<`` and ``[`` (and ``|`` in
roles), so no text can hold a mark, and taking the points away again restores it. Sums of the tokens of earlier turns
cut a conversation into spans of whole turns; each span becomes one window with the system turn, a limited number
of turns before the span, and the span itself. Only the assistant turns of the span are under the loss mask, so
every target counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import running_sums, staged

BUDGET = 512
HISTORY = 64
OPEN, CLOSE, END = "<|", "|>", "<|/|>"
CHARS_PER_TOKEN = 4
CELL_TURNS = 256
_KEY = ["c", "cn"]


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<.")), F.lit("["), F.lit("[."))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<."), F.lit("<")), F.lit("[."), F.lit("["))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("|"), F.lit("|."))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("|."), F.lit("|")))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Formatted windows ``conv_id, window, formatted, loss, context, tokens`` of all conversations.

    ``turns`` has ``conv_id, turn, role, text``. Turns are ordered by ``turn`` (null first), then role and text;
    null roles and texts are empty, a null ``conv_id`` is a conversation of its own. A system turn is one that
    opens the conversation with the role ``system``. ``window`` is the number of the span's first turn; ``loss``
    lists start (from 0) and length, in code points of ``formatted``; the first ``context`` turns of a window are
    repeated ones. Tokens are estimated as a quarter of the formatted characters. A window keeps to ``budget``
    unless its system turn or a single turn does not leave room; no turn is cut or dropped. Turns of the span
    before are repeated as far as they fit in ``history``. Repeated rows are turns like any other; an empty
    table gives no rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    marked = F.concat(F.lit(OPEN), escape_role(role), F.lit(CLOSE))
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("c"),
        F.col("conv_id").isNull().alias("cn"),
        F.coalesce(F.floor(F.col("turn") / CELL_TURNS), F.lit(-(1 << 62))).alias("cell"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.length(marked).alias("head"),
        F.ceil((F.length(marked) + F.length(escape(text)) + len(END)) / CHARS_PER_TOKEN).alias("tokens"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = staged(running_sums(rows, _KEY, "cell", ["turn", "role", "text"], {"start": "tokens", "n": "one"}).drop("turn", "one"), "turns")
    piece = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(CLOSE), escape(F.col("text")), F.lit(END)).alias("piece")
    opens = (F.col("n") == 0) & (F.col("role") == "system")
    system = staged(placed.where(opens).select(*_KEY, F.col("tokens").alias("system_tokens"), piece), "system")
    room = F.greatest(F.lit(2), F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)))
    # the spans are found on numbers alone; the texts join them once
    sized = placed.drop("text", "head").join(system.drop("piece"), _KEY, "left").withColumn("stride", F.floor(room / 2))
    longs = sized.withColumn("long", (F.col("tokens") > F.col("stride")).cast("long"))
    counted = running_sums(longs, _KEY, "cell", ["n"], {"longs": "long"})
    span = [*_KEY, "longs", "long", "block"]
    spanned = staged(counted.select(*_KEY, "n", "role", "tokens", "start", "longs", "long", F.floor(F.col("start") / F.col("stride")).alias("block")), "spanned")
    spans = staged(
        spanned.groupBy(*span).agg(F.min("n").alias("window"), F.max("n").alias("last"), F.max(F.col("start") + F.col("tokens")).alias("stop")), "spans"
    )
    again = ~opens & (F.col("stop") - F.col("start") <= history)
    places = F.array(
        F.struct(F.col("window").alias("window"), F.lit(True).alias("target")),
        F.when(again, F.struct((F.col("last") + 1).alias("window"), F.lit(False).alias("target"))),
    )
    where = spanned.join(spans, span).select(*_KEY, "n", F.array_compact(places).alias("places"))
    inside = placed.join(where, [*_KEY, "n"]).select(*_KEY, F.explode("places").alias("place"), "role", "head", "text", "tokens", "n")
    inside = inside.select(*_KEY, "place.window", "role", "head", piece, "tokens", "n", "place.target")
    kept = spans.where("window > 0").join(system, _KEY).select(
        *_KEY, "window", F.lit("system").alias("role"), F.lit(0).alias("head"), "piece",
        F.col("system_tokens").alias("tokens"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("target"),
    )
    parts = inside.unionByName(kept)
    grouped = parts.groupBy(*_KEY, "window").agg(
        F.sort_array(F.collect_list(F.struct("n", "target", "role", "head", "piece"))).alias("parts"),
        F.sum("tokens").alias("tokens"),
        F.count(F.when(~F.col("target"), 1)).alias("context"),
        F.max("target").alias("real"),
    )
    none = F.array().cast("array<struct<start:int,length:int>>")

    def place(state: Column, part: Column) -> Column:
        learned = F.struct((state["at"] + part["head"]).alias("start"), (F.length(part["piece"]) - part["head"] - len(END)).alias("length"))
        return F.struct(
            (state["at"] + F.length(part["piece"])).alias("at"),
            F.when(part["target"] & (part["role"] == "assistant"), F.concat(state["loss"], F.array(learned))).otherwise(state["loss"]).alias("loss"),
        )

    loss = F.aggregate("parts", F.struct(F.lit(0).alias("at"), none.alias("loss")), place)["loss"]
    return grouped.where("real").select(
        F.when(~F.col("cn"), F.col("c")).alias("conv_id"),
        "window",
        F.concat_ws("", F.transform("parts", lambda p: p["piece"])).alias("formatted"),
        loss.alias("loss"),
        "context",
        "tokens",
    )


def read_turns(formatted: Column, context: Column) -> Column:
    """The turns of a window that are not repeated ones, as an array of ``role, text``."""
    pieces = F.split(formatted, r"<\|/\|>")
    own = F.slice(pieces, context + 1, F.size(pieces) - 1 - context)

    def parse(piece: Column) -> Column:
        close = F.instr(piece, CLOSE)
        return F.struct(
            unescape_role(F.substring(piece, len(OPEN) + 1, close - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, close + len(CLOSE), F.length(piece))).alias("text"),
        )

    return F.transform(own, parse)


def read_targets(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask of a window, unescaped, as an array."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from them: one row per conversation."""
    turns = read_turns(F.col("formatted"), F.col("context"))
    lines = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    targets = F.concat_ws("", read_targets(F.col("formatted"), F.col("loss")))
    read = formatted.select("conv_id", "window", F.size(turns).alias("n"), lines.alias("lines"), targets.alias("targets"), F.length("formatted").alias("chars"))
    whole = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "lines", "targets"))).alias("w"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"),
    )
    join = lambda name: F.concat_ws("", F.transform("w", lambda x: x[name]))
    return whole.select(
        "conv_id", "n_turns", F.sha2(join("lines"), 256).alias("turns_sha256"), F.length(join("targets")).cast("long").alias("loss_chars"),
        F.sha2(join("targets"), 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )
