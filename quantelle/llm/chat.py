"""Chat formatting of typed content parts with a reversible template and a loss mask.

Only DataFrame expressions: a conversation is formatted and parsed inside the JVM.

Template of one turn: ``<turn>ROLE\\nCONTENT</turn>\\n``. Inside role and text a
backslash becomes ``\\\\`` and ``<`` becomes ``\\l`` (in roles a line feed becomes
``\\n``), so a raw ``<`` occurs in markers only. Attachments become
``<part KIND NUMBER>``, numbered through the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
#: Content types that become placeholders; any other type is formatted as text.
ATTACHMENTS = ("image", "audio", "document")
PART_TYPE = "array<struct<kind:string,text:string,ref:string,tokens:int>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Inverse of ``escape_role`` and, since a text keeps its line feeds, of ``escape``."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(plain, "\\")


def text_part(text: Column) -> Column:
    """A single text part, the parts of a plain message."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(0).alias("tokens"))).cast(PART_TYPE)


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*ATTACHMENTS), F.lit(False))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
                         trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted``, ``loss``, ``attachments``, ``attachment_tokens``.

    ``parts`` has the type ``PART_TYPE``. Turns are taken by ``turn``, ties by role and
    content, repeated rows stay; NULL turns come first and NULL conversation ids form one
    conversation. NULL roles, texts, part arrays and parts count as empty. ``loss`` holds
    the spans ``[start, end)``, in code points of ``formatted``, of the text parts of
    ``trained`` turns, attachments left out. ``attachments`` lists number, kind, reference,
    expanded token count and position of each placeholder, in order. An empty table gives
    no rows. Other columns, whatever their names, are ignored.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.filter(F.coalesce(F.col(f"`{parts}`"), F.array().cast(PART_TYPE)), lambda p: p.isNotNull()).alias("parts"))
    rows = rows.withColumn("n_attached", F.size(F.filter("parts", _is_attachment)))
    order = Window.partitionBy("conv").orderBy("turn", "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("first", F.coalesce(F.sum("n_attached").over(before), F.lit(0)))

    def number(i: Column) -> Column:
        return F.col("first") + F.size(F.filter(F.slice("parts", F.lit(1), i), _is_attachment))

    def visit(part: Column, i: Column) -> Column:
        return F.when(_is_attachment(part), F.concat(F.lit("<part "), part["kind"], F.lit(" "), number(i).cast("string"), F.lit(">"))).otherwise(
            escape(F.coalesce(part["text"], F.lit(""))))

    rows = rows.withColumn("flat", F.transform("parts", visit))
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")))
    rows = rows.withColumn("piece", F.concat("head", F.array_join("flat", ""), F.lit(CLOSE)))
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)).cast("long"))

    def at(i: Column) -> Column:
        return F.col("start") + F.length("head") + F.length(F.array_join(F.slice("flat", F.lit(1), i), ""))

    placed = F.transform("parts", lambda p, i: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(0)).alias("tokens"), number(i).cast("long").alias("number"),
        at(i).alias("start"), (at(i) + F.length(F.get("flat", i))).alias("end"), _is_attachment(p).alias("attached")))
    rows = rows.withColumn("placed", placed)
    gathered = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(
        "start", "piece", (F.col("role") == trained).alias("trained"), "placed"))).alias("t"))
    attached = F.filter(F.flatten(F.transform("t", lambda x: x["placed"])), lambda p: p["attached"])
    spoken = F.filter(F.flatten(F.transform(F.filter("t", lambda x: x["trained"]), lambda x: x["placed"])),
                      lambda p: ~p["attached"] & (p["end"] > p["start"]))
    return gathered.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(spoken, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("loss"),
        F.transform(attached, lambda p: F.struct(*[p[c].alias(c) for c in ("number", "kind", "ref", "tokens", "start", "end")])).alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda s, p: s + p["tokens"]).alias("attachment_tokens"))


def parse_turns(formatted: Column) -> Column:
    """Turns of a formatted conversation as an array of ``(role, text)``; placeholders stay."""
    pieces = F.split(formatted, "</turn>\n")

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        head = F.substring_index(body, "\n", 1)
        return F.struct(unescape(head).alias("role"), _unescape_text(F.substr(body, F.length(head) + 2)).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def _unescape_text(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, r"\\\\"), lambda p: F.replace(p, F.lit("\\l"), F.lit("<"))), "\\")


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: _unescape_text(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digest columns read back from ``format_conversations`` output."""
    turns, lost = parse_turns(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss"))
    read = formatted.select(F.col(f"`{conv}`").alias(conv), "formatted", turns.alias("turns"), lost.alias("lost"))
    return read.select(
        conv, F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
