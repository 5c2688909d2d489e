"""Chat formatting with a grammar that gives every turn back, in DataFrame functions only.

Grammar of a formatted conversation (turns in ascending ``turn``, null first, then by role and text)::

    conversation = { turn }
    turn         = "### " role ": " text "</turn>" "\\n"

The parser is deterministic: it cuts the string after each ``</turn>`` and line feed, takes what stands between ``### ``
and the first ``: `` as the role and the rest as the text, and then undoes escapes in both from left to right: a
backslash and the character behind it stand for that character, in a role ``\\c`` stands for a colon.

Rendering escapes only what conflicts. A turn is first rendered as it is and parsed again; where the parse differs from
the source, its role and text are escaped (backslash, ``</turn>`` and, in a role, colon) and the conversation is parsed
as a whole; where that still differed, all its turns would be escaped; a conversation that could not be recovered even
so would stop the job (no string is known that does).

Null role or text: empty. Null conversation id: rows with it are one conversation. Repeated rows are turns of their
own. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "### ", ": ", "</turn>"
END = CLOSE + "\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CLOSE), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return F.array_join(F.transform(F.split(role, r"\\\\", -1), lambda x: unescape(F.replace(x, F.lit("\\c"), F.lit(":")))), "\\")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(SEP), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>; what is no turn has a null role."""
    pieces = F.split(formatted, CLOSE, -1)
    many = F.size(pieces)

    def one(x: Column, i: Column) -> Column:
        x = F.when(i == 0, x).when(x.startswith("\n"), F.substring(x, 2, 2_147_483_647))
        at = F.instr(x, SEP)
        role = F.when(x.startswith(OPEN) & (at > len(OPEN)), F.substr(x, F.lit(len(OPEN) + 1), at - len(OPEN) - 1))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(x, at + len(SEP), F.lit(2_147_483_647))).alias("text"))

    turns = F.transform(F.slice(pieces, 1, F.greatest(many - 1, F.lit(0))), one)
    return F.when(F.element_at(pieces, -1) == F.when(many > 1, F.lit("\n")).otherwise(F.lit("")), turns)


def format_chats(rows: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """A row for each conversation: conv_id, formatted, and loss, the spans (start, length in code points, of the text
    as it stands in formatted) of the turns of the trained roles.
    """
    turns = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    back = parse(render(F.col("role"), F.col("text")))
    same = F.coalesce((F.size(back) == 1) & (F.get(back, F.lit(0))["role"] == F.col("role")) & (F.get(back, F.lit(0))["text"] == F.col("text")), F.lit(False))
    turns = turns.withColumn("same", same)
    turn = F.struct("turn", "role", "text", F.when(F.col("same"), F.col("role")).otherwise(escape_role(F.col("role"))).alias("r"), F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text"))).alias("t"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def recovered(formatted: Column) -> Column:
        return F.coalesce(parse(formatted) == F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))), F.lit(False))

    def joined(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda x: render(x["r"], x["t"])), "")

    chats = chats.withColumn("first", recovered(joined(F.col("turns"))))
    full = F.transform("turns", lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text"), escape_role(x["role"]).alias("r"), escape(x["text"]).alias("t")))
    chats = chats.withColumn("turns", F.when(F.col("first"), F.col("turns")).otherwise(full)).withColumn("formatted", joined(F.col("turns")))
    checked = F.when(recovered(F.col("formatted")), F.col("formatted")).otherwise(F.raise_error(F.concat(F.lit("not recovered: conversation "), F.col("conv_id").cast("string"))))
    # Positions: a turn's text begins behind all turns before it and its own opening and role.
    ends = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss")),
        lambda a, x: F.struct(
            (a["at"] + F.length(render(x["r"], x["t"]))).cast("long").alias("at"),
            F.when(x["role"].isin(*trained), F.concat(a["loss"], F.array(F.struct((a["at"] + len(OPEN) + F.length(x["r"]) + len(SEP)).cast("long").alias("start"), F.length(x["t"]).cast("long").alias("length"))))).otherwise(a["loss"]).alias("loss"),
        ),
    )
    return chats.select("conv_id", checked.alias("formatted"), ends["loss"].alias("loss"))


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the output recovers: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    got = formatted.withColumn("turns", parse(F.col("formatted")))
    loss = F.array_join(F.transform("loss", lambda x: unescape(F.substr("formatted", (x["start"] + 1).cast("int"), x["length"].cast("int")))), "")
    got = got.withColumn("masked", loss)
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
