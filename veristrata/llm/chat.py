"""Chat formatting with typed content parts, in DataFrame functions only.

A turn becomes ``<turn>role\\ncontent</turn>\\n``. Roles and texts are escaped so that no ``<`` of theirs
remains; every ``<`` in the output belongs to the template, and the escapes can be undone.

Parts of a turn are visited in order: text parts give their escaped text; all others give a placeholder
``<image 1>`` numbered within the turn, an attachment record (number, type, reference) and the number of
tokens that the placeholder stands for.

Defined cases: NULL text, role or part counts as empty; a part of an unknown type is a ``file`` of no
tokens; NULL sizes count as zero; turns are ordered by (turn, role, content), NULLs first, so that ties and
repeated rows have one order; rows with NULL conversation form one conversation; an empty table gives no
row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

OPEN, CLOSE = "<turn>", "</turn>\n"

PART = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("ref", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("pages", T.IntegerType()),
])

# Tokens that a placeholder stands for: one for each 28 x 28 patch of an image, 25 a second of sound,
# 1024 a page of a document.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 1024


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Each backslash is followed by one letter, so that the order of these replacements is safe."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A turn of plain text as an array of parts."""
    fields = [F.lit("text").alias("type"), text.cast("string").alias("text")]
    fields += [F.lit(None).cast(f.dataType).alias(f.name) for f in PART.fields[2:]]
    return F.array(F.struct(*fields))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _kind(part: Column) -> Column:
    return F.when(part["type"].isin("image", "audio", "document"), part["type"]).otherwise("file")


def _tokens(part: Column) -> Column:
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(0)) / PATCH)
    count = (
        F.when(part["type"] == "image", side("width") * side("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
        .otherwise(0)
    )
    return count.cast("long")


def visit(turns: DataFrame) -> DataFrame:
    """Adds ``content`` (texts and placeholders in order), ``attachments`` and ``placeholder_tokens`` to
    rows that have ``parts``."""
    parts = F.coalesce(F.col("parts"), F.expr("array()").cast(T.ArrayType(PART)))
    placed = F.transform(parts, lambda p, i: F.struct(i.alias("at"), p.alias("p")))
    others = F.filter(parts, lambda p: ~_is_text(p))
    texts = F.transform(
        F.filter(placed, lambda x: _is_text(x["p"])),
        lambda x: F.struct(x["at"].alias("at"), escape(F.coalesce(x["p"]["text"], F.lit(""))).alias("s")),
    )
    # The place in the filtered array is the placeholder's number; sorting by ``at`` puts both kinds in order again.
    marks = F.transform(
        F.filter(placed, lambda x: ~_is_text(x["p"])),
        lambda x, i: F.struct(
            x["at"].alias("at"),
            F.concat(F.lit("<"), _kind(x["p"]), F.lit(" "), (i + 1).cast("string"), F.lit(">")).alias("s"),
        ),
    )
    content = F.transform(F.sort_array(F.concat(texts, marks)), lambda x: x["s"])
    attachments = F.transform(
        others,
        lambda p, i: F.struct(
            (i + 1).alias("number"), _kind(p).alias("type"), p["ref"].alias("ref"),
            _tokens(p).alias("tokens"),
        ),
    )
    return turns.withColumns({
        "content": F.array_join(content, ""),
        "attachments": attachments,
        "placeholder_tokens": F.aggregate(attachments, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]),
    })


def format_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                 trained_role: str = "assistant") -> DataFrame:
    """One row per conversation from rows (key, order, role, parts).

    Returns key, ``formatted``, ``loss_spans`` (start from 1 and length, in characters of the output, of the
    content of each turn of ``trained_role``), ``attachments`` (with the position of the turn) and
    ``placeholder_tokens``. A conversation is one text, so its turns meet in one row; nothing else is
    gathered.
    """
    rows = visit(turns.select(F.col(key), F.col(order), F.coalesce("role", F.lit("")).alias("role"), "parts"))
    rows = rows.select(
        key, order, "role", "content", "attachments", "placeholder_tokens",
        F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
    )
    rendered = F.concat("head", "content", F.lit(CLOSE))
    in_order = Window.partitionBy(key).orderBy(order, "role", "content")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select(
        key, "role", "head", "content", "attachments", "placeholder_tokens",
        F.row_number().over(in_order).alias("position"),
        F.coalesce(F.sum(F.char_length(rendered)).over(before), F.lit(0)).alias("offset"),
    )
    span = F.when(
        F.col("role") == trained_role,
        F.struct(
            (F.col("offset") + F.char_length("head") + 1).cast("int").alias("start"),
            F.char_length("content").alias("length"),
        ),
    )
    gathered = placed.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("position", F.concat("head", "content", F.lit(CLOSE)).alias("text"))))
        .alias("texts"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
        F.sort_array(F.collect_list(F.when(F.size("attachments") > 0, F.struct("position", "attachments"))))
        .alias("attachments"),
        F.sum("placeholder_tokens").alias("placeholder_tokens"),
    )
    return gathered.select(
        key,
        F.array_join(F.transform("texts", lambda t: t["text"]), "").alias("formatted"),
        "loss_spans", "attachments", "placeholder_tokens",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), escapes undone."""
    pieces = F.split(formatted, CLOSE.replace("/", "\\/"))
    whole = F.slice(pieces, 1, F.size(pieces) - 1)
    head = lambda piece: F.substring_index(piece, "\n", 1)
    return F.transform(
        whole,
        lambda piece: F.struct(
            unescape_role(F.substr(head(piece), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(piece, F.char_length(head(piece)) + 2)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, escapes undone."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"], s["length"])))


def digest(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """The numbers of the contract, read back from ``formatted`` and ``loss_spans``."""
    read = conversations.select(
        key, "formatted", read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
