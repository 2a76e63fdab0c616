"""Chat formatting of turns made of typed content parts.

A visitor turns each part into text: a text part is escaped, an image, audio or document part becomes
a placeholder, and its reference and the tokens it expands to are recorded in order. Turns are
marked; the loss mask is a list of character ranges that cover the assistant's content.

Control strings start with ``<|``. In texts, one backslash is put before the ``|`` of every
``<``, any backslashes, ``|``, so ``<|`` in the output is always the template's own, and taking one
backslash away restores the text.

Defined cases: null texts, roles and part lists are empty; turns with equal numbers follow by role
and content, turns without a number come last; a null conv_id is a conversation; unknown kinds of
parts count as text; an empty table gives no rows; other columns are not read. A conversation is one
row of the output, so it has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
_WORDS = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _visit(part: Column) -> Column:
    """What a part becomes: its text in the output, and the attachment it stands for."""
    zero = F.lit(0)
    image = F.ceil(F.coalesce(part["width"], zero) / PATCH) * F.ceil(F.coalesce(part["height"], zero) / PATCH)
    audio = F.ceil(F.coalesce(part["seconds"], zero) * AUDIO_RATE)
    document = F.coalesce(part["pages"], zero) * PAGE_TOKENS
    kind = F.coalesce(part["kind"], F.lit("text"))

    def by_kind(image_, audio_, document_, text_):
        return F.when(kind == "image", image_).when(kind == "audio", audio_).when(kind == "document", document_).otherwise(text_)

    return F.struct(
        by_kind(*[F.lit(f"<|{k}|>") for k in ("image", "audio", "document")], escaped(part["text"])).alias("text"),
        F.when(kind.isin("image", "audio", "document"), kind).alias("kind"),
        part["ref"].alias("ref"),
        by_kind(image, audio, document, F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(_WORDS))).cast("long").alias("tokens"),
    )


def text_part(text: str) -> Column:
    """A part list of one text."""
    nothing = F.lit(None)
    fields = [F.lit("text"), F.col(text).cast("string"), *[nothing] * 5]
    return F.array(F.struct(*fields).cast(PART))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, parts array of ``PART``).

    Columns: conv_id, formatted, loss (start from 1 and length of each range, in characters),
    attachments (kind, ref, tokens in order of their placeholders), tokens (expanded).
    """
    role = F.replace(escaped(F.col("role").cast("string")), F.lit("\n"), F.lit(NEWLINE))
    flat = turns.select(
        "conv_id",
        F.struct(F.col("turn").isNull(), "turn", F.coalesce("role", F.lit("")), F.coalesce("parts", F.array().cast(f"array<{PART}>"))).alias("order"),
        (F.coalesce("role", F.lit("")) == "assistant").alias("learned"),
        F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
        F.transform(F.coalesce("parts", F.array().cast(f"array<{PART}>")), _visit).alias("visited"),
    ).withColumn("body", F.array_join(F.transform("visited", lambda p: p["text"]), ""))
    flat = flat.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    by_turn = Window.partitionBy("conv_id").orderBy("order")
    flat = flat.withColumn("place", F.row_number().over(by_turn)).withColumn(
        "end", F.sum(F.char_length("piece")).over(by_turn.rowsBetween(Window.unboundedPreceding, 0))
    )
    span = F.struct((F.col("end") - F.char_length("piece") + F.char_length("head") + 1).alias("start"), F.char_length("body").cast("long").alias("length"))
    row = F.struct("place", "piece", F.when(F.col("learned"), span).alias("span"), "visited")
    whole = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    visited = F.flatten(F.transform("rows", lambda r: r["visited"]))
    attached = F.transform(F.filter(visited, lambda p: p["kind"].isNotNull()), lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss"),
        attached.alias("attachments"),
        F.aggregate(F.transform(visited, lambda p: p["tokens"]), F.lit(0).cast("long"), lambda x, y: x + y).alias("tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds; placeholders stay in the text."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.greatest(F.size(F.split(formatted, r"<\|im_start\|>")) - 1, F.lit(0)))

    def turn(piece):
        role = F.substring_index(piece, "\n", 1)
        first = F.char_length(role) + 2
        text = F.substring(piece, first, F.char_length(piece) - first + 1 - len(END) - 1)
        return F.struct(unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n"))).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"].cast("int"), s["length"].cast("int")))), "")
