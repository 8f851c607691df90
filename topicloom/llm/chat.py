"""Chat formatting by event-sourced reconstruction, a reversible template and a loss mask.

Method: logs are partitioned by conversation and sorted by sequence; the events of each message are
folded into its final text (``message`` and ``edit`` set it, ``delta`` appends to it, ``regenerate``
sets it and drops the later messages that existed before the regeneration). The final messages are
rendered by the template; the output holds the formatted text and the loss mask (code point spans of
every assistant text). :func:`read_back` parses the written output again.

Template: ``<|turn|>`` role ``<|body|>`` text ``<|end|>`` and a newline, per message in order. Role and
text are escaped so that neither contains ``<|``: a backslash becomes two, and ``<|`` becomes
``\\l``. Unescaping reads the escaped text left to right, so the round trip is exact for every string.

All work runs in the JVM. A conversation is one output row, so its messages meet in one task (a
training example cannot be split); messages and conversations are otherwise independent.

Special rows: null text or role read as ''. Event sequences that tie are ordered by kind, role and
text. A null conversation id is a conversation of its own. Deltas without an earlier ``message`` start
from ''. An empty log gives no rows. Columns other than the event columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.session import scratch_path

# The template.
START, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"
LOSS_ROLE = "assistant"
RESETS = ("message", "edit", "regenerate")
# Fixed values of the query's contract: conversation -7, whose texts look like template markers.
PLANTED_CONVERSATION = -7
PLANTED_TEXT = "\\### Assistant: </turn> ok"
_BACKSLASH_PAIR = r"\\\\"  # Java regex of two backslashes


def escape(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("\\l"))


def unescape(col: Column) -> Column:
    parts = F.split(col, _BACKSLASH_PAIR, -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\l"), F.lit("<|"))), "\\")


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, msg_id, role, text`` of an event log
    ``conv_id, seq, msg_id, kind, role, text``."""
    e = events.select(
        "conv_id", "seq", "msg_id", F.coalesce("kind", F.lit("message")).alias("kind"),
        F.col("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    reset = F.col("kind").isin(*RESETS)
    folded = e.groupBy("conv_id", "msg_id").agg(
        F.max(F.when(reset, F.col("seq"))).alias("_reset"),
        F.min("seq").alias("_created"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.array_sort(F.collect_list(F.struct("seq", reset.alias("reset"), "text"))).alias("_events"),
    )
    text = F.array_join(
        F.transform(
            F.filter("_events", lambda x: F.col("_reset").isNull() | (x["seq"] > F.col("_reset")) | ((x["seq"] == F.col("_reset")) & x["reset"])),
            lambda x: x["text"],
        ),
        "",
    )
    messages = folded.select("conv_id", "msg_id", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), "_created")
    # regenerations drop later messages that existed before them
    regen = e.where(F.col("kind") == "regenerate").select("conv_id", "msg_id", F.lit(1).alias("_type"), F.col("seq").alias("_at"))
    stream = messages.select("conv_id", "msg_id", F.lit(0).alias("_type"), F.col("_created").alias("_at"), "role", "text").unionByName(
        regen, allowMissingColumns=True
    )
    before = Window.partitionBy("conv_id").orderBy("msg_id", "_type").rowsBetween(Window.unboundedPreceding, -1)
    marked = stream.withColumn("_cut", F.max(F.when(F.col("_type") == 1, F.col("_at"))).over(before))
    return marked.where((F.col("_type") == 0) & (F.col("_cut").isNull() | (F.col("_cut") <= F.col("_at")))).select(
        "conv_id", "msg_id", "role", "text"
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask`` (spans ``start, end`` in code points, end exclusive)."""
    role, text = escape(F.col("role")), escape(F.col("text"))
    piece = F.concat(F.lit(START), role, F.lit(BODY), text, F.lit(END))
    head = F.lit(len(START) + len(BODY)) + F.char_length(role)
    earlier = Window.partitionBy("conv_id").orderBy("msg_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        messages.withColumn("_piece", piece)
        .withColumn("_offset", F.coalesce(F.sum(F.char_length("_piece")).over(earlier), F.lit(0)).cast("bigint"))
        .withColumn("_start", F.col("_offset") + head)
        .withColumn(
            "_span",
            F.when(F.col("role") == LOSS_ROLE, F.struct(F.col("_start").alias("start"), (F.col("_start") + F.char_length(text)).cast("bigint").alias("end"))),
        )
    )
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("msg_id", "_piece", "_span"))).alias("_m"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("_m", lambda m: m["_piece"]), "").alias("formatted"),
        F.filter(F.transform("_m", lambda m: m["_span"]), lambda s: s.isNotNull()).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text parsed from ``conv_id, formatted, loss_mask``:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    pieces = F.split("formatted", r"<\|", -1)
    roles = F.filter(pieces, lambda x, i: i % 3 == 1)
    texts = F.filter(pieces, lambda x, i: i % 3 == 2)
    turns = F.zip_with(
        roles, texts, lambda r, t: F.concat(unescape(F.substring(r, 7, 1 << 30)), F.lit("\n"), unescape(F.substring(t, 7, 1 << 30)), F.lit("\n"))
    )
    loss = F.array_join(
        F.transform("loss_mask", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))),
        "",
    )
    return formatted.select(
        "conv_id",
        F.size(roles).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def turn_events(conversations: DataFrame) -> DataFrame:
    """Rows by turn as ``message`` events: one message per row, ordered by turn (nulls last), role, text."""
    c = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "role", "text")
    numbered = c.withColumn("msg_id", F.row_number().over(order).cast("bigint"))
    return numbered.select("conv_id", F.col("msg_id").alias("seq"), "msg_id", F.lit("message").alias("kind"), "role", "text")


def format_chats(spark: SparkSession, events: DataFrame, path: str | None = None) -> DataFrame:
    """Reconstruct, render, write as Parquet below the shared folder (or ``path``), and read back."""
    out = path or scratch_path(spark, "chats")
    render(reconstruct(events)).write.parquet(out)
    return read_back(spark.read.parquet(out))


__all__ = ["escape", "format_chats", "read_back", "reconstruct", "render", "turn_events", "unescape"]
