"""Chat formatting: typed content parts flattened into one marked-up text per conversation.

A visitor over the parts of each turn writes text parts escaped and image, audio and
document parts as numbered placeholders; every placeholder is recorded with its
reference and the tokens it expands to. Everything is a DataFrame expression.

Format of one turn: `<|turn|>` role line-feed body `<|end|>` line-feed. Inside roles and
texts `&`, `<` and `[` become `&amp;`, `&lt;` and `&#91;` (line feeds in roles `&#10;`), so
no control string of this or of the usual templates can occur there, and `unescaped`
gives back the very text.

Defined cases: a null text or part list is empty, a null role the empty role, a null
turn comes first; rows that tie on turn are ordered by role and text; repeated rows are
repeated turns; rows with a null conv_id form one conversation of their own; a part of an
unknown kind becomes an `other` placeholder that expands to no tokens; further columns
are never read. A conversation is one value of the result, so it is gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
# Escapes, in the order in which they are written.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPE = ("\n", "&#10;")
#: Tokens that one unit (image tile, second of audio, page) of a part expands to.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 800}
PART = "struct<kind:string,text:string,ref:string,units:long>"


def escaped(text: Column, role: bool = False) -> Column:
    for plain, safe in (*ESCAPES, *([ROLE_ESCAPE] if role else [])):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    for plain, safe in (*([ROLE_ESCAPE] if role else []), *reversed(ESCAPES)):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A part list of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units"),
    ))


def kind_of(part: Column) -> Column:
    kind = F.lower(F.coalesce(part["kind"], F.lit("other")))
    return F.when(kind.isin("text", *TOKENS_PER_UNIT), kind).otherwise("other")


def visited(part: Column, turn: Column, place: Column) -> Column:
    """What a part becomes in the body."""
    mark = F.concat(
        F.lit("<|"), kind_of(part), F.lit(":"), turn.cast("string"), F.lit("."),
        place.cast("string"), F.lit("|>"),
    )
    text = escaped(F.coalesce(part["text"], F.lit("")))
    return F.when(kind_of(part) == "text", text).otherwise(mark)


def expanded(part: Column) -> Column:
    """Tokens of a part: words of a text, units times their rate of an attachment."""
    rate = F.lit(0)
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(kind_of(part) == kind, tokens).otherwise(rate)
    words = F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    attached = rate * F.coalesce(part["units"], F.lit(1))
    return F.when(kind_of(part) == "text", words).otherwise(attached).cast("long")


def format_chat(
    turns: DataFrame, parts: str | None = None, learn_from: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: the formatted text, loss spans, attachments, token count.

    `turns` has conv_id, turn, role and either text or, if `parts` names one, a column of
    part lists. `loss_spans` holds (start, length) in code points, start from 1, of the
    bodies of turns whose role is in `learn_from`, and where that is in the turns: the
    number of the turn and the place in it, both from 1.
    """
    content = F.col(parts).cast(f"array<{PART}>") if parts else text_part(F.col("text"))
    flat = turns.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(content, F.lit(None).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
        .alias("content"),
    )
    by = Window.partitionBy("conv_id").orderBy("turn", "role", F.to_json("content"))
    numbered = flat.withColumn("at", F.row_number().over(by))
    body = F.array_join(
        F.transform("content", lambda p, i: visited(p, F.col("at"), i + 1)), "")
    head = F.concat(F.lit(TURN), escaped(F.col("role"), role=True), F.lit("\n"))
    marked = F.filter(
        F.transform("content", lambda p, i: F.struct(
            F.col("at").alias("turn"), (i + 1).alias("part"), kind_of(p).alias("kind"),
            p["ref"].alias("ref"), expanded(p).alias("tokens"))),
        lambda m: m["kind"] != "text",
    )
    tokens = F.aggregate(
        F.transform("content", expanded), F.lit(0).cast("long"), lambda a, x: a + x)
    written = numbered.select(
        "conv_id", "at", "role", head.alias("head"), body.alias("body"),
        marked.alias("marked"), tokens.alias("tokens"),
    )
    piece = F.concat("head", "body", F.lit(END))
    placed = written.withColumn("piece", piece).withColumn(
        "before",
        F.coalesce(
            F.sum(F.char_length("piece")).over(
                Window.partitionBy("conv_id").orderBy("at")
                .rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)),
    )
    span = F.struct(
        (F.col("before") + F.char_length("head") + 1).cast("int").alias("start"),
        F.char_length("body").cast("int").alias("length"),
        F.col("at").cast("int").alias("turn"),
        (F.char_length("head") + 1).cast("int").alias("place"),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "at", "piece", F.col("role").isin(*learn_from).alias("learn"), span.alias("span"),
            "marked", "tokens"))).alias("all"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("all", lambda x: x["learn"]), lambda x: x["span"])
        .alias("loss_spans"),
        F.flatten(F.transform("all", lambda x: x["marked"])).alias("attachments"),
        F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
        .alias("n_tokens"),
    )


def cut_chat(formatted: Column) -> Column:
    """The turns of a formatted text as they stand in it, without their ends."""
    return F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted text as structs of role and text."""
    return read_turns(cut_chat(formatted))


def read_turns(pieces: Column) -> Column:
    """The turns that `cut_chat` found as structs of role and text."""

    def turn(piece: Column) -> Column:
        bare = F.substring(piece, F.lit(len(TURN) + 1), F.char_length(piece))
        cut = F.instr(bare, "\n")
        return F.struct(
            unescaped(F.substring(bare, F.lit(1), cut - 1), role=True).alias("role"),
            unescaped(F.substring(bare, cut + 1, F.char_length(bare))).alias("text"),
        )

    return F.transform(pieces, turn)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digests read back from the formatted text and its loss spans.

    A span is looked up in its turn: counting characters from the start of a long
    conversation for every span would grow with the square of its length.
    """
    # Unpacked by a generator, so that the text is cut once and not for every span.
    cut = formatted.select(
        "*", F.explode(F.array(cut_chat(F.col("formatted")))).alias("_pieces"))
    read = cut.withColumn("turns", read_turns(F.col("_pieces"))).withColumn(
        "loss",
        F.array_join(
            F.transform("loss_spans", lambda s: unescaped(F.substring(
                F.get("_pieces", s["turn"] - 1), s["place"], s["length"]))), ""))
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
    )
