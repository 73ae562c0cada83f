"""Chat formatting by prefix-target expansion: one example for every assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    r"""Text in which no mark can occur: ``<\`` becomes ``<\\`` and ``<|`` becomes ``<\|``."""
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """The inverse of escape()."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("<\\\\"), F.lit("<\\"))


def _role_out(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_in(role: Column) -> Column:
    for plain, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def expand_targets(conversations: DataFrame) -> DataFrame:
    """One example for every assistant turn, with all turns before it as context and only its text trainable.

    Input: conv_id, turn, role, text. Output: conv_id, example (from 0 within a
    conversation), n_turns, formatted, loss_start and loss_end (code points of
    ``formatted``; the text of the last turn, without its end mark), is_whole
    (it holds all turns of its conversation). A conversation that doesn't end
    with an assistant turn has one example more, with all its turns and nothing
    trainable (loss_start and loss_end null), so that no turn is lost.

    Texts are escaped, see escape(); roles are percent-encoded where they hold
    a line feed, % or <. Contexts are whole: the output grows with the square
    of a conversation's length, as the method implies. A task holds the text of one
    conversation once, as the longest example does, whatever the number of its turns.

    Defined cases: null text and null role are empty; a null conv_id is a
    conversation of its own; turns are ordered by turn (null first), then role,
    then text, repeated rows each count; very long texts stay whole; an empty table gives no examples;
    other columns aren't used.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("escaped", escape(F.col("text")))
    turns = turns.withColumn("part", F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"), "escaped", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assistant = F.col("role") == "assistant"
    placed = turns.select(
        "conv_id",
        F.row_number().over(order).alias("n_turns"),
        F.lead(F.lit(False), 1, True).over(order).alias("is_whole"),
        F.sum(assistant.cast("int")).over(upto).alias("answers"),
        assistant.alias("trainable"),
        F.length("escaped").alias("n_escaped"),
        F.sum(F.length("part")).over(upto).alias("upto"),
        "part",
    )
    # a conversation's text is built once, and each example is cut from its beginning
    place = F.struct("n_turns", "is_whole", "answers", "trainable", "n_escaped", F.col("upto").cast("int").alias("upto"))
    held = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n_turns", "part"))).alias("parts"), F.collect_list(F.when(F.col("trainable") | F.col("is_whole"), place)).alias("places"))
    whole = held.select("conv_id", F.array_join("parts.part", "").alias("text"), "places").select("conv_id", "text", F.inline("places"))
    stop = F.when(F.col("trainable"), F.col("upto") - len(END))
    return whole.select(
        "conv_id",
        (F.col("answers") - F.when(F.col("trainable"), 1).otherwise(0)).cast("bigint").alias("example"),
        F.col("n_turns").cast("bigint").alias("n_turns"),
        F.substring("text", F.lit(1), F.col("upto")).alias("formatted"),
        (stop - F.col("n_escaped")).alias("loss_start"),
        stop.alias("loss_end"),
        "is_whole",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as array<struct<role, text>>."""
    return F.transform(
        F.filter(F.split(formatted, r"<\|im_start\|>"), lambda s, i: i > 0),
        lambda s: let(
            F.instr(s, "\n"),
            lambda at: F.struct(
                _role_in(F.substring(s, F.lit(1), at - 1)).alias("role"),
                unescape(F.substring(s, at + 1, F.length(s) - at - len(END))).alias("text"),
            ),
        ),
    )


def read_loss(formatted: Column, start: Column, stop: Column) -> Column:
    """The unescaped text under the loss mask; null where nothing is trainable."""
    return unescape(F.substring(formatted, start + 1, stop - start))


def digest(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from their formatted texts."""
    joined = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = examples.select(
        "conv_id",
        "example",
        F.when(F.col("is_whole"), F.size(read_turns(F.col("formatted")))).cast("bigint").alias("n_turns"),
        F.when(F.col("is_whole"), F.sha2(joined, 256)).alias("turns_sha256"),
        read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
        F.length("formatted").cast("bigint").alias("chars"),
    )
    answers = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))), lambda x: x["loss"]), "")
    return (
        rows.groupBy("conv_id")
        .agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), answers.alias("loss"), F.sum("chars").alias("formatted_chars"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
    )
