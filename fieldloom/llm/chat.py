"""Chat formatting with a grammar round trip.

A conversation is rendered as one text::

    ### <role>/<level>: <text></turn>

one turn after the other, each ended by a newline.  ``### `` and ``</turn>`` are
control strings: neither may stand inside a turn.  Every turn is rendered at
level 0 (as it is), reparsed, and compared with its source; where that
differs, level 1 breaks the control strings with a backslash, and where that differs
too (the text held a broken control string already) level 2 replaces every
backslash, ``#`` and ``<`` by a two-character code, which is reversible for any
text.  Roles are always coded, the colon too.  The parser is deterministic: cut
at the terminator, read the header, refuse a turn with a control string inside,
undo the level.

Defined results: a null text or role is empty; rows of a conversation are ordered by
turn (nulls first), then role, then text, so ties and repeated rows have one order;
rows without conv_id form one conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "### ", "</turn>", "</turn>\n"
BROKEN_OPEN, BROKEN_CLOSE = r"#\## ", r"<\/turn>"
CODES = (("\\", r"\b"), ("#", r"\h"), ("<", r"\l"))
ROLE_CODES = (*CODES, (":", r"\c"), ("\n", r"\n"))
LEVELS = 3


def swapped(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def coded(text: Column, codes) -> Column:
    return swapped(text, codes)  # the backslash comes first


def decoded(text: Column, codes) -> Column:
    return swapped(text, [(new, old) for old, new in reversed(codes)])  # and here last


def escaped(text: Column, level: int) -> Column:
    if level == 0:
        return text
    if level == 1:
        return swapped(text, ((OPEN, BROKEN_OPEN), (CLOSE, BROKEN_CLOSE)))
    return coded(text, CODES)


def unescaped(text: Column, level: Column) -> Column:
    return (F.when(level == "0", text)
            .when(level == "1", swapped(text, ((BROKEN_CLOSE, CLOSE), (BROKEN_OPEN, OPEN))))
            .otherwise(decoded(text, CODES)))


def render(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(OPEN), coded(role, ROLE_CODES), F.lit(f"/{level}: "),
                    escaped(text, level), F.lit(END))


def parse(rendered: Column) -> Column:
    """Turns of a rendered conversation: array of role, level, text (still escaped);
    null where the text is not of the grammar."""
    pieces = F.split(rendered, END, -1)  # the terminator holds no pattern characters

    def turn(piece: Column) -> Column:
        header = F.regexp_extract(piece, r"\A### [^:#]*/[0-2]: ", 0)
        head = F.char_length(header)
        body = F.substr(piece, head + 1)
        ok = (head > 0) & ~F.contains(body, F.lit(OPEN)) & ~F.contains(body, F.lit(CLOSE))
        level = F.substr(header, head - 2, F.lit(1))
        role = F.substr(header, F.lit(len(OPEN) + 1), head - len(OPEN) - 4)
        return F.when(ok, F.struct(decoded(role, ROLE_CODES).alias("role"), level.alias("level"),
                                   body.alias("escaped")))

    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
    whole = (F.element_at(pieces, -1) == "") & ~F.exists(turns, lambda t: t.isNull())
    return F.when(whole, turns)


def same_turn(rendered: Column, role: Column, text: Column) -> Column:
    got = parse(rendered)
    return F.coalesce((F.size(got) == 1) & (got[0]["role"] == role)
                      & (unescaped(got[0]["escaped"], got[0]["level"]) == text), F.lit(False))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, source (array of role, text): one row per conversation."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")
    # most texts hold nothing to escape, for them the cheap test is the round trip's result
    plain = ~F.contains(text, F.lit("##")) & ~F.contains(text, F.lit("<")) & ~text.endswith("#")
    shown = F.when(plain, render(role, text, 0))
    for level in range(LEVELS):
        tried = render(role, text, level)
        shown = shown.when(same_turn(tried, role, text), tried)
    shown = shown.otherwise(F.raise_error(F.lit("no level of escaping reads back as written")))
    turns = rows.select("conv_id", F.struct("turn", "role", "text", shown.alias("shown")).alias("t"))
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.array_join(F.col("turns.shown"), "").alias("formatted"),
                          F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("source"))


def read_back(shown: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), spans (start, stop of each assistant text
    in ``formatted``, code points, escapes included).  Raises where the turns read differ
    from the source."""
    parsed = shown.select("conv_id", "formatted", "source", parse(F.col("formatted")).alias("parsed"))
    turns = parsed.select("conv_id", "formatted", "source", "parsed", F.transform(
        "parsed", lambda t: F.struct(t["role"].alias("role"), unescaped(t["escaped"], t["level"])
                                     .alias("text"))).alias("turns"))
    checked = F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("conversation reads back differently: "),
                               F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return turns.select("conv_id", "formatted", "parsed", checked.alias("turns"))


def loss_spans(read: DataFrame) -> DataFrame:
    """``read_back`` with ``spans``: what the loss mask covers in ``formatted``, and the
    level of escaping there."""
    def step(acc: Column, t: Column) -> Column:
        size = F.char_length(t["escaped"])
        start = acc["at"] + len(OPEN) + F.char_length(coded(t["role"], ROLE_CODES)) + 4
        return F.struct((start + size + len(END)).alias("at"), F.when(
            t["role"] == "assistant", F.concat(acc["spans"], F.array(F.struct(
                start.alias("start"), (start + size).alias("stop"), t["level"].alias("level"))))).otherwise(
            acc["spans"]).alias("spans"))
    none = F.array().cast("array<struct<start:int,stop:int,level:string>>")
    return read.withColumn("spans", F.aggregate(
        "parsed", F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"]))


def chat_digest(read: DataFrame) -> DataFrame:
    """Digests of ``read_back``: only what was parsed from the output enters them, and
    for the loss what the mask cuts out of it."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("spans", lambda s: unescaped(
        F.substr("formatted", s["start"] + 1, s["stop"] - s["start"]), s["level"])), "")
    return loss_spans(read).select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(whole, 256).alias("turns_sha256"), learnt.alias("learnt"),
                       F.char_length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")
