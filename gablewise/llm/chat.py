r"""Conversations as one text each for training, and back, by Spark expressions only.

The template:  <s>  then blocks, one for each stretch of turns of the same role, its texts joined by [NEXT]:

    user        [INST] ... [/INST]
    assistant   ...</s>                          its texts are under the loss mask
    any other   [ROLE]its name[TEXT]...[/ROLE]

A text or a name that holds one of these strings, or one of them with backslashes behind its first character, gets one more
backslash there: [INST] is written [\INST], [\INST] is written [\\INST]. So no text holds a control string once written, all other
texts are written as they are, and taking one backslash away gives every text back.

A conversation of more than SEGMENT turns is formatted in parts of so many turns: ranks come from key ranges and prefix sums, and a part knows
the role before it and after it. So no task collects or folds more than SEGMENT turns, however long a conversation is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, save

#: Fixed strings of the template, and the two patterns that find them.
SQUARE, ANGLE = "/?INST|/?ROLE|TEXT|NEXT", "/?s"
TO_ESCAPE = rf"\[(?=\\*+(?:{SQUARE})\])|<(?=\\*+(?:{ANGLE})>)"
TO_UNESCAPE = rf"(?<=\[)\\(?=\\*+(?:{SQUARE})\])|(?<=<)\\(?=\\*+(?:{ANGLE})>)"
BEGIN, NEXT, USER_END, ASSISTANT_END, OTHER_END = "<s>", "[NEXT]", " [/INST]", "</s>", "[/ROLE]"
BLOCK_ENDS = r"(?<=\[/INST\])|(?<=</s>)|(?<=\[/ROLE\])"
#: Turns that are collected together at most.
SEGMENT = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, TO_ESCAPE, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, TO_UNESCAPE, "")


def opening(role: Column) -> Column:
    named = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[TEXT]"))
    return F.when(role == "user", "[INST] ").when(role == "assistant", "").otherwise(named)


def closing(role: Column) -> Column:
    return F.when(role == "user", USER_END).when(role == "assistant", ASSISTANT_END).otherwise(OTHER_END)


def parted(turns: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """turns (conv, turn, role, text) in two: those of conversations of a segment at most, and those of others with `part`: the rank by turn over the segment."""
    counts = turns.groupBy("conv").count().where(F.col("count") > segment)
    long = save(counts.select(F.col("conv").alias("long")), "chat-long")
    hint = broadcast_if_small(long)
    same = F.col("conv").eqNullSafe(F.col("long"))
    short = turns.join(hint, same, "left_anti")
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    # a range holds a share of a conversation; rows that are wholly alike may lie on either side of a cut
    ranged = turns.join(hint, same, "left_semi").withColumn("tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange("conv", *order, "tie").withColumn("range", F.spark_partition_id())
    ranged = save(ranged, "chat-ranges")
    sizes = ranged.groupBy("conv", "range").count()
    before = F.sum("count").over(W.partitionBy("conv").orderBy("range")) - F.col("count")
    sizes = sizes.select(F.struct("conv").alias("of"), F.col("range").alias("in"), before.alias("before"))
    row = F.row_number().over(W.partitionBy("conv", "range").orderBy(*order, "tie")) - 1
    ranked = ranged.withColumn("row", row).join(broadcast_if_small(save(sizes, "chat-sizes")), (F.col("range") == F.col("in")) & F.struct("conv").eqNullSafe(F.col("of")))
    rank = F.col("before") + F.col("row")
    return short, ranked.select(*turns.columns, F.floor(rank / segment).alias("part"), rank.alias("rank"))


def blocks(turns: Column) -> Column:
    """Sorted turns, those of the same role that stand together as one: structs (role, texts)."""
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")
    fold = lambda out, t: F.when(
        F.try_element_at(out, F.lit(-1)).role == t.role,
        F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(t.role.alias("role"), F.concat(F.element_at(out, -1).texts, F.array(t.text)).alias("texts")))),
    ).otherwise(F.concat(out, F.array(F.struct(t.role.alias("role"), F.array(t.text).alias("texts")))))
    return F.aggregate(turns, none, fold)


def clean(turns: DataFrame) -> DataFrame:
    return turns.select("conv", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))


def written(short: DataFrame, long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, part, formatted, loss) of both. Texts are shuffled once, to where a part's turns are collected."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    nothing = F.lit(None).cast("string")
    first = short.groupBy("conv").agg(turns).select("conv", F.lit(0).cast("long").alias("part"), "turns", nothing.alias("before"), nothing.alias("after"))
    # the roles on either side of each part, from narrow rows
    ends = long.select("conv", "part", "rank", "role").groupBy("conv", "part").agg(F.min_by("role", "rank").alias("first"), F.max_by("role", "rank").alias("last"))
    by_part = W.partitionBy("conv").orderBy("part")
    near = ends.select(F.struct("conv").alias("of"), F.col("part").alias("at"), F.lag("last").over(by_part).alias("before"), F.lead("first").over(by_part).alias("after"))
    many = long.groupBy("conv", "part").agg(turns).join(near, (F.col("part") == F.col("at")) & F.struct("conv").eqNullSafe(F.col("of")))
    return write(first), write(many.select("conv", "part", "turns", "before", "after"))


def write(parts: DataFrame) -> DataFrame:
    """(conv, part, formatted, loss) of parts (conv, part, turns, before, after): the roles that stand before and after tell what goes on there."""
    x = parts.withColumn("blocks", blocks(F.col("turns"))).drop("turns")

    # the pieces of a part in order: openings, texts, joints and ends; those of assistants' texts are marked
    def pieces(b: Column, i: Column) -> Column:
        starts = (i > 0) | ~F.coalesce(F.col("before") == b.role, F.lit(False))
        ends = (i < F.size("blocks") - 1) | ~F.coalesce(F.col("after") == b.role, F.lit(False))
        piece = lambda text, mask: F.struct(text.alias("text"), mask.alias("mask"))
        texts = F.flatten(F.transform(b.texts, lambda t, k: F.array(piece(F.when(k > 0, NEXT).otherwise(""), F.lit(False)), piece(escape(t), b.role == "assistant"))))
        return F.concat(F.array(piece(F.when(starts, opening(b.role)).otherwise(NEXT), F.lit(False))), texts, F.array(piece(F.when(ends, closing(b.role)).otherwise(""), F.lit(False))))

    begin = F.array(F.struct(F.when(F.col("part") == 0, BEGIN).otherwise("").alias("text"), F.lit(False).alias("mask")))
    x = x.select("conv", "part", F.concat(begin, F.flatten(F.transform("blocks", pieces))).alias("pieces"))
    step = lambda s, p: F.struct(
        (s.at + F.length(p.text)).alias("at"), F.when(p.mask, F.concat(s.loss, F.array(F.struct((s.at + 1).alias("start"), F.length(p.text).alias("length"))))).otherwise(s.loss).alias("loss")
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    return x.select("conv", "part", F.array_join(F.col("pieces.text"), "").alias("formatted"), F.aggregate("pieces", zero, step).loss.alias("loss"))


def format_parts(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, part, formatted, loss): the written parts of conversations; loss has (start, length) of each assistant's text in its part.

    turns has conv (of any type), turn, role and text. Turns go by `turn`, nulls first, ties by role and text; a null role or text is
    an empty one; rows that are wholly alike are turns like others. The parts of a conversation, joined by part, are its text.
    """
    short, long = written(*parted(clean(turns), segment))
    return short.unionByName(long)


def read_back(formatted: Column) -> Column:
    """The turns, structs (role, text) in order, that a conversation's whole text holds."""
    body = F.substr(formatted, F.lit(len(BEGIN) + 1))
    blocks = F.filter(F.split(body, BLOCK_ENDS), lambda b: b != "")

    def turns(b: Column) -> Column:
        user, assistant = b.endswith("[/INST]"), b.endswith(ASSISTANT_END)
        role = F.when(user, "user").when(assistant, "assistant").otherwise(unescape(F.substring_index(F.substr(b, F.lit(len("[ROLE]") + 1)), "[TEXT]", 1)))
        start = F.when(user, F.lit(len("[INST] "))).when(assistant, 0).otherwise(F.instr(b, F.lit("[TEXT]")) + len("[TEXT]") - 1)
        end = F.when(user, F.lit(len(USER_END))).when(assistant, len(ASSISTANT_END)).otherwise(len(OTHER_END))
        inner = F.substr(b, start + 1, F.length(b) - start - end)
        return F.transform(F.split(inner, r"\[NEXT\]"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the mask."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s.start, s.length))), "")


def conversation_texts(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, formatted, under): each conversation's whole text and what lies under its loss mask.

    Whole texts are values of Spark, which end at 2 GB; longer conversations have their parts only. Those of one part aren't shuffled again.
    """
    short, long = (x.withColumn("under", masked(F.col("formatted"), F.col("loss"))) for x in written(*parted(clean(turns), segment)))
    texts = ("formatted", "under")
    joined = long.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", *texts))).alias("all"))
    joined = joined.select("conv", *(F.array_join(F.col(f"all.{c}"), "").alias(c) for c in texts))
    return short.select("conv", *texts).unionByName(joined)


def conversation_digests(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the texts."""
    x = conversation_texts(turns, segment).withColumn("turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return x.select(
        "conv", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("under").cast("long").alias("loss_chars"),
        F.sha2("under", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_example(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as conv (added, conv_id), turn, role, text, and conversation -1, whose texts hold control strings."""
    example = conversations.sparkSession.createDataFrame([(-1, k, r, "</s>[INST] ok [/INST]") for k, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    one = lambda df, added: df.select(F.struct(F.lit(added).alias("added"), F.col("conv_id").cast("long").alias("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return one(conversations, False).unionByName(one(example, True))


def formatted_conversations(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conversation_digests of all conversations and the example, by conv_id.

    Rows without a conv_id are one conversation; one that has the id -1 in the table stays apart from the example. An empty table gives the
    example alone; other columns don't matter.
    """
    return conversation_digests(with_example(conversations), segment).select(F.col("conv.conv_id").alias("conv_id"), F.expr("* EXCEPT (conv)"))
