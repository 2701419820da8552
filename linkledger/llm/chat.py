"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, merged where neighbours share a role, and joined to text:

    ### role: first text</turn>
    second text of the same role</turn>
    ### other role: text</turn>

Each line above ends with a line feed after ``</turn>``. Inside texts a backslash becomes ``\\\\``, the first ``#`` of
``###`` becomes ``\\h`` and the ``<`` of ``</turn>`` becomes ``\\l``; roles also write ``:`` as ``\\c``. So no text can
hold a mark of the template, and reading back is exact, merged turns included.

A conversation is formatted in parts of ``PART_TURNS`` turn numbers, and these in chunks of as many rows, so that no
array grows with a conversation. Its formatted text is its parts and chunks in order, the same as if made at once: one
that goes on with the role before it has no header, and names that role in ``carried``. Null texts and roles are empty.
Null turns come first; rows with the same turn are ordered by role and text and all stay, repeated ones too. Rows
with a null conversation id form one conversation. An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Turn numbers per part and rows per chunk: the bound of every collected array.
PART_TURNS = 256
TURN_END = "</turn>\n"
HEADER = "### "


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, "#(?=##)", r"\\h")
    return F.regexp_replace(text, "<(?=/turn>)", r"\\l")


def unescape(text: Column) -> Column:
    def plain(piece: Column) -> Column:
        for mark, char in ((r"\h", "#"), (r"\l", "<"), (r"\c", ":")):
            piece = F.replace(piece, F.lit(mark), F.lit(char))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def _merge(turns: Column) -> Column:
    """Blocks of neighbouring turns with one role, from sorted turn structs."""
    def add(blocks: Column, turn: Column) -> Column:
        last = F.element_at(blocks, -1)
        longer = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        one = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return (
            F.when(F.size(blocks) == 0, F.array(one))
            .when(last["role"] == turn["role"], F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(longer)))
            .otherwise(F.concat(blocks, F.array(one)))
        )

    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")
    return F.aggregate(turns, empty, add)


def _carried(turns: DataFrame) -> DataFrame:
    """The last role of the part before, for every part but a conversation's first: one row per part, without texts."""
    last = turns.groupBy("key").agg(F.max(F.struct("turn", "role"))["role"].alias("role"))
    before = F.lag("role").over(Window.partitionBy("key.conv_id").orderBy("key.part"))
    return last.select("key", before.alias("carried")).filter("carried is not null")


def format_parts(conversations: DataFrame) -> DataFrame:
    """One row per conversation, part and chunk: conv_id, part, chunk, carried, formatted, loss_spans (start and end, in
    code points of the row's text, of every assistant text)."""
    # Structs are equal as keys where both have nulls.
    turns = conversations.select(
        F.struct("conv_id", F.floor(F.col("turn") / PART_TURNS).alias("part")).alias("key"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("key").orderBy("turn", "role", "text")
    turns = turns.join(_carried(turns), "key", "left").select(
        "key", F.row_number().over(order).alias("at"), "role", "text",
        F.coalesce(F.lag("role").over(order), "carried").alias("before"))
    turns = turns.select(
        "key", F.floor((F.col("at") - 1) / PART_TURNS).alias("chunk"),
        F.struct("at", "role", "text", "before").alias("said"))
    blocks = turns.groupBy("key", "chunk").agg(F.sort_array(F.collect_list("said")).alias("said")).select(
        "key.*", "chunk", F.col("said")[0]["before"].alias("carried"), _merge(F.col("said")).alias("blocks"))

    def pieces(block: Column, at: Column) -> Column:
        head = F.concat(F.lit(HEADER), F.replace(escape(block["role"]), F.lit(":"), F.lit(r"\c")), F.lit(": "))
        goes_on = (at == 0) & F.col("carried").eqNullSafe(block["role"])
        return F.transform(block["texts"], lambda text, i: F.struct(
            F.when((i == 0) & ~goes_on, head).otherwise(F.lit("")).alias("head"), escape(text).alias("body"),
            (block["role"] == "assistant").alias("learn"),
        ))

    blocks = blocks.select(
        "conv_id", "part", "chunk", "carried", F.flatten(F.transform("blocks", pieces)).alias("pieces"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["head"])
        end = start + F.length(piece["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(TURN_END)).alias("at"),
            F.when(piece["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    joined = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), "").alias("formatted")
    return blocks.select("conv_id", "part", "chunk", "carried", joined, F.aggregate("pieces", begin, step)["spans"].alias("loss_spans"))


def read_back(parts: DataFrame) -> DataFrame:
    """The turns (role and text, in order) and the learned texts of each row of parts, from its formatted text
    and the role that it goes on with."""
    def turn(state: Column, piece: Column) -> Column:
        headed = F.startswith(piece, F.lit(HEADER))
        role = F.when(headed, unescape(F.regexp_extract(piece, "^### ([^:]*): ", 1))).otherwise(
            F.coalesce(F.try_element_at(state, F.lit(-1))["role"], F.col("carried")))
        text = unescape(F.when(headed, F.regexp_replace(piece, "^### [^:]*: ", "")).otherwise(piece))
        return F.concat(state, F.array(F.struct(role.alias("role"), text.alias("text"))))

    lines = F.split("formatted", TURN_END)
    lines = F.slice(lines, F.lit(1), F.size(lines) - 1)
    return parts.select(
        "conv_id", "part", "chunk", "formatted",
        F.aggregate(lines, F.array().cast("array<struct<role:string,text:string>>"), turn).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(
            F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))).alias("learned"),
    )


def digests(parts: DataFrame) -> DataFrame:
    """Counts and digests per conversation, read back from formatted parts."""
    back = read_back(parts).select(
        "conv_id", "part", "chunk", F.size("turns").alias("n"), F.length("formatted").alias("chars"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
        .alias("said"),
        F.array_join("learned", "").alias("learned"),
    )
    whole = back.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "chunk", "said", "learned"))).alias("parts"),
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
    ).withColumns({
        "said": F.array_join("parts.said", ""), "learned": F.array_join("parts.learned", ""),
    })
    return whole.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
