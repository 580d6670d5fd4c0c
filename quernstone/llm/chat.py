"""Chat formatting: every participant's view of a dialogue, native Spark throughout (operator 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import cut_lineage

#: The template: a header, the message and an end mark make a segment.
OWN, OTHER, CONTEXT, END = "<|assistant|>\n", ("<|user name=", "|>\n"), "<|system|>\n", "<|end|>\n"
#: Bytes of conversation ids that are broadcast at most.
BROADCAST = 1 << 24


def _plain(text: Column) -> Column:
    """Text in which nothing can be taken for a mark of the template."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(speaker: Column) -> Column:
    """A speaker's name in which nothing can end a header either: no closing mark and no line end."""
    one_line = F.regexp_replace(_plain(F.coalesce(speaker, F.lit("unknown"))), "[\\n\\r\\x0b\\x0c\\x85\u2028\u2029]+", " ")
    return F.replace(one_line, F.lit("|>"), F.lit("| >"))


def _crowded(said: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """The rows of blocks of more than ``block_rows`` rows, and the other rows; None if there are no such blocks.

    Turns without numbers, or with one number, can't be parted by number. Equal rows become one row with
    ``copies``, and the rows are dealt to ranges of their order, each with its number ``sub``.
    """
    full = said.groupBy("conv", "block").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
    full = cut_lineage(full.select(F.col("conv").alias("c"), F.col("block").alias("b"), "n"))
    n, size = full.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.coalesce(F.octet_length(F.col("c").cast("string")), F.lit(0)) + 32), F.lit(0))).first()
    if not n:
        return None
    full = F.broadcast(full.drop("n")) if size <= BROADCAST else full.drop("n")
    at = F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    order = ["conv", "block", "turn", "speaker", "message"]
    crowd = said.join(full, at, "left_semi").groupBy(*order).agg(F.count("*").alias("copies"))
    crowd = crowd.repartitionByRange(-(-n * 2 // block_rows), *order).withColumn("sub", F.spark_partition_id())
    return cut_lineage(crowd), said.join(full, at, "left_anti")


def perspectives(turns: DataFrame, context: tuple[str, ...] = ("system",), block: int = 1024, block_rows: int = 1 << 16, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text") -> DataFrame:
    """For each dialogue and each participant, the dialogue with that speaker as assistant, message by message.

    Rows: ``conv_id``, ``perspective`` (the participant), ``position`` (from 0), ``turn``, ``speaker``,
    ``chat_role`` (``assistant`` for the participant's own turns, ``system`` for speakers in ``context``, else
    ``user``), ``segment`` (header, message and end mark; a user's header has the speaker's name), ``start`` and
    ``end`` (characters of the segment in the rendered dialogue, which is the segments in order of position),
    ``learn`` (the mask: true on own turns) and ``learn_start``, ``learn_end`` (the characters that it covers:
    message and end mark; null where ``learn`` is false). Speakers in ``context`` are no participants; a dialogue
    without participants has no rows.

    A dialogue may be of any length: offsets are summed in blocks of ``block`` turn numbers, whose totals are
    summed again, so a task sees a block of a dialogue at a time and the text is shuffled once. Blocks of more
    than ``block_rows`` rows are parted further, by ranges of the order of their rows, after equal rows were
    counted; their text is checkpointed once.

    Null texts are empty messages, a null speaker is called ``unknown``, turns without number come last and rows
    without conversation id are one dialogue. Turns with equal numbers are in order of speaker and text, and
    repeated rows are turns of their own. Marks of the template in names and texts are broken up: ``<|`` becomes
    ``< |``, and in names ``|>`` becomes ``| >`` and line ends become a space. Further columns are left out, and an
    empty table has no rows.
    """
    block_of = F.coalesce(F.floor(F.col(turn_col) / block), F.lit((1 << 62) // block))
    said = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), _name(F.col(speaker_col)).alias("speaker"), _plain(F.col(text_col)).alias("message"), block_of.alias("block"))
    parted = _crowded(said, block_rows)
    said = (parted[1] if parted else said).withColumns({"copies": F.lit(1).cast("long"), "sub": F.lit(0)})
    if parted:
        said = said.unionByName(parted[0])
    said = said.withColumn("block", F.struct("block", "sub")).drop("sub")
    is_context = F.col("speaker").isin(*context) if context else F.lit(False)
    in_context = F.when(is_context, F.lit(CONTEXT))
    other = F.coalesce(in_context, F.concat(F.lit(OTHER[0]), "speaker", F.lit(OTHER[1])))
    said = said.withColumn("other_size", F.length(other) + F.length("message") + len(END))

    # The turns' number and size for each speaker of a block, and from them each participant's blocks.
    spoken = said.groupBy("conv", "block", "speaker").agg(F.sum("copies").alias("n"), F.sum(F.col("other_size") * F.col("copies")).alias("size"))
    people = spoken.filter(~is_context).select("conv", F.col("speaker").alias("perspective")).distinct()
    blocks = spoken.groupBy("conv", "block").agg(F.sum("n").alias("block_n"), F.sum("size").alias("block_size"))
    own = spoken.select(F.col("conv").alias("c"), F.col("block").alias("b"), "speaker", "n")
    shorter = F.length(F.concat(F.lit(OTHER[0]), "perspective", F.lit(OTHER[1]))) - len(OWN)
    views = blocks.join(people.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    views = views.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")) & (F.col("perspective") == F.col("speaker")), "left").drop("c", "b", "speaker")
    before = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("block_size") - shorter * F.coalesce("n", F.lit(0))
    views = views.select(F.col("conv").alias("c"), F.col("block").alias("b"), "perspective", F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("first"), F.coalesce(F.sum(size).over(before), F.lit(0)).alias("offset"))

    seen = said.join(views, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    mine = F.col("speaker") == F.col("perspective")
    segment = F.concat(F.when(mine, F.lit(OWN)).otherwise(other), "message", F.lit(END))
    inside = Window.partitionBy("conv", "block", "perspective").orderBy(F.col("turn").asc_nulls_last(), "speaker", "message").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    length = F.col("other_size") - F.when(mine, shorter).otherwise(0)
    out = seen.withColumn("length", length).withColumns({"position": F.col("first") + before("copies"), "start": F.col("offset") + before(F.col("length") * F.col("copies"))})
    if parted:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        out = out.withColumns({"position": F.col("position") + F.col("copy"), "start": F.col("start") + F.col("length") * F.col("copy")})
    out = out.withColumn("end", F.col("start") + F.col("length"))
    return out.select(
        F.col("conv").alias("conv_id"),
        "perspective",
        "position",
        "turn",
        "speaker",
        F.when(mine, "assistant").when(is_context, "system").otherwise("user").alias("chat_role"),
        segment.alias("segment"),
        "start",
        "end",
        mine.alias("learn"),
        F.when(mine, F.col("start") + len(OWN)).alias("learn_start"),
        F.when(mine, F.col("end")).alias("learn_end"),
    )


def dialogues(messages: DataFrame, max_messages: int = 4096) -> DataFrame:
    """The rows of ``perspectives`` joined to texts: one for each dialogue and participant.

    Columns: ``conv_id``, ``perspective``, ``part``, ``start`` (characters before this part), ``rendered`` and
    ``spans``, the ``learn_start`` and ``learn_end`` of the participant's own turns, counted from the dialogue's
    begin. A dialogue of more than ``max_messages`` messages takes several parts, so no row and no group is
    larger than that; the parts in order are the dialogue.
    """
    part = F.floor(F.col("position") / max_messages).cast("long").alias("part")
    message = F.struct("position", "start", "segment", "learn_start", "learn_end")
    gathered = messages.groupBy("conv_id", "perspective", part).agg(F.array_sort(F.collect_list(message)).alias("m"))
    spans = F.transform(F.filter("m", lambda x: x["learn_start"].isNotNull()), lambda x: F.struct(x["learn_start"].alias("learn_start"), x["learn_end"].alias("learn_end")))
    return gathered.select("conv_id", "perspective", "part", F.get("m", F.lit(0))["start"].alias("start"), F.array_join(F.col("m.segment"), "").alias("rendered"), spans.alias("spans"))
