"""Chat formatting: quotes are linked to what they quote and taken out.

Lines that begin with ``>`` are quoted, one level for each ``>``. Consecutive
lines of one level are a passage; it is normalised, hashed and looked up among
the passages that earlier messages of the conversation wrote themselves. A
passage that none of them wrote as a whole is looked up by its lines and
sentences, among theirs. A message replies to the message that its outermost
linked passage came from.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.operators import skew
from crivo.sources.tables import staged


def quote_level(line: Column) -> Column:
    """How many ``>`` a line begins with, blanks between them allowed."""
    marks = F.regexp_extract(line, r"^[\x20\x09]*((?:>[\x20\x09]*)*)", 1)
    return F.length(F.regexp_replace(marks, r"[^>]", ""))


def normalised(passage: Column) -> Column:
    """Lower case, white space as single blanks, no punctuation at either end."""
    flat = F.regexp_replace(F.lower(passage), r"\s+", " ")
    return F.regexp_replace(flat, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def passages(text: Column) -> Column:
    """Array of (level, passage): runs of lines of one level, in order.

    Blank lines end a passage and belong to none. ``passage`` keeps the line
    ends, without the marks.
    """
    line = F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"),
        lambda x: F.struct(
            quote_level(x).alias("level"),
            F.regexp_replace(x, r"^[\x20\x09]*>[\x20\x09>]*", "").alias("line"),
        ),
    )
    marked = F.transform(
        line, lambda x: F.struct(x["level"].alias("level"), x["line"].alias("line"), (F.trim(x["line"]) == "").alias("blank"))
    )

    def cut(lines: Column) -> Column:
        """A run opens and closes where the next line to either side is blank,
        of another level or missing, so each line is looked at a few times."""

        def ends(step: int):
            def at_end(i: Column) -> Column:
                here, there = F.get(lines, i), F.get(lines, i + step)
                apart = there["blank"] | (there["level"] != here["level"])
                return ~here["blank"] & F.coalesce(apart, F.lit(True))

            return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), at_end)

        return F.zip_with(
            ends(-1),
            ends(1),
            lambda first, last: F.struct(
                F.get(lines, first)["level"].alias("level"),
                F.array_join(
                    F.transform(F.slice(lines, first + 1, last - first + 1), lambda x: x["line"]), "\n"
                ).alias("passage"),
            ),
        )

    # As the element of an array the lines are worked out once for all of this.
    return F.transform(F.array(marked), cut)[0]


def parts(passage: Column) -> Column:
    """The distinct lines and sentences of a passage, normalised."""
    flat = F.regexp_replace(passage, r"\s+", " ")
    sentences = F.split(flat, r"(?<=[.!?])\x20|(?<=[\u3002\uff01\uff1f])")
    every = F.transform(F.concat(F.split(passage, "\n"), sentences), normalised)
    return F.array_distinct(F.filter(every, lambda x: x != ""))


def linked_messages(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each message, in the reply order of its conversation.

    Columns: conv_id, turn, role, text (its own words, quotes taken out),
    n_quotes, n_linked, reply_to (turn; null without a link), thread (first turn
    of its chain of replies, its own without a link), depth (links up to it),
    position (from 0: threads by first turn, within each by turn), chat
    (``<|role|>`` and the text).

    A quoted passage links to the first earlier message of the conversation
    that wrote it. When none did, its lines and sentences are looked up among
    those that earlier messages wrote: the longest that is found counts, of
    equals the latest message. Of the linked passages the one of the lowest level
    counts, of equals the latest message. A quote of which no whole line or
    sentence has an original is taken out all the same and counted in
    ``n_quotes`` only. Null roles are empty, null texts
    too; a null conversation or turn links with nothing and rows of a null
    conversation are one conversation. Repeated rows stay and have positions of
    their own; where rows share a turn, what one wrote the turn wrote.
    """
    base = messages.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("whole"),
    )
    # Most messages quote nothing; their text is not taken apart.
    quotes = F.col("whole").rlike(r"(?m)^[\x20\x09]*>")
    lines = F.split("whole", r"\r\n|\r|\n")
    own = F.array_join(F.filter(lines, lambda x: quote_level(x) == 0), "\n")
    base = base.select(
        "*",
        F.when(quotes, F.regexp_replace(F.regexp_replace(own, r"\n{3,}", "\n\n"), r"^\s+|\s+$", ""))
        .otherwise(F.col("whole"))
        .alias("text"),
        quotes.alias("quoting"),
    )
    rows = staged(
        base.withColumn("id", F.xxhash64("conv_id", "turn", "role", "whole")), "messages"
    )
    quoted = (
        rows.where("quoting")
        .select("id", "conv_id", "turn", F.explode(passages(F.col("whole"))).alias("p"))
        .select("id", "conv_id", "turn", "p.level", "p.passage", normalised(F.col("p.passage")).alias("said"))
        .where("level > 0")
        .groupBy("id", "conv_id", "turn", "level", "said")
        .agg(F.min("passage").alias("passage"))
        .withColumn("hash", F.xxhash64("said"))
    )
    quoted = staged(quoted, "quoted")
    # Only conversations that quote need their passages hashed.
    asked = quoted.select("conv_id").distinct()
    wrote = staged(
        rows.join(asked, "conv_id", "left_semi")
        .select("conv_id", "turn", F.explode(passages(F.col("whole"))).alias("p"))
        .where("p.level = 0")
        .select("conv_id", "turn", "p.passage"),
        "wrote",
    )

    def first_of(said: DataFrame) -> DataFrame:
        hashes = said.select("conv_id", "turn", F.xxhash64("said").alias("hash"))
        return hashes.groupBy("conv_id", "hash").agg(F.min("turn").alias("source"))

    written = first_of(wrote.withColumn("said", normalised(F.col("passage"))))
    whole = staged(
        quoted.join(staged(written, "written"), ["conv_id", "hash"], "left").withColumn(
            "source", F.when((F.col("source") < F.col("turn")) & (F.col("said") != ""), F.col("source"))
        ),
        "by_passage",
    )
    pieces = staged(
        whole.where("source IS NULL")
        .select("id", "level", F.col("hash").alias("of"), "conv_id", "turn", F.explode(parts(F.col("passage"))).alias("said"))
        .withColumn("hash", F.xxhash64("said")),
        "pieces",
    )
    # The same for what was written: only where a passage found no original.
    asked = pieces.select("conv_id").distinct()
    written = first_of(
        wrote.join(asked, "conv_id", "left_semi").withColumn("said", F.explode(parts(F.col("passage"))))
    )
    by_part = (
        pieces.join(staged(written, "written_parts"), ["conv_id", "hash"])
        .where(F.col("source") < F.col("turn"))
        .groupBy("id", "level", F.col("of").alias("hash"))
        .agg(F.max(F.struct(F.length("said").alias("length"), "source"))["source"].alias("part_source"))
    )
    linked = (
        whole.join(staged(by_part, "by_part"), ["id", "level", "hash"], "left")
        .withColumn("source", F.coalesce("source", "part_source"))
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("n_quotes"),
            F.count("source").alias("n_linked"),
            F.max(
                F.when(
                    F.col("source").isNotNull(),
                    F.struct((-F.col("level")).alias("near"), F.col("source").alias("source")),
                )
            )["source"].alias("reply_to"),
        )
    )
    # Identical rows have one id and one answer, so this adds no rows.
    rows = staged(rows.join(staged(linked, "linked"), "id", "left"), "replies")
    chains = _chains(
        rows.where("reply_to IS NOT NULL").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("top"))
    )
    rows = rows.join(chains, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "reply_to",
        F.coalesce("top", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text").alias("chat"),
    )
    rows = staged(rows, "threads")
    return skew.position_in_group(
        rows,
        "conv_id",
        ["thread", "turn", "role", "chat"],
        [*skew.key_levels(F.col("thread")), F.col("thread"), *skew.key_levels(F.col("turn")), F.col("turn")],
        "position",
        skew.hot_keys(rows, "conv_id"),
    )


def _chains(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, top, depth) by pointer doubling: a chain of n replies
    takes log2(n) joins. Replies go to earlier turns, so there is no cycle."""
    step = staged(replies.withColumn("depth", F.lit(1).cast("long")), "chains")
    while True:
        up = step.select(
            "conv_id", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more")
        )
        longer = staged(
            step.join(up, ["conv_id", "top"], "left").select(
                "conv_id",
                "turn",
                F.coalesce("next", "top").alias("top"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "chains",
        )
        step = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return step
