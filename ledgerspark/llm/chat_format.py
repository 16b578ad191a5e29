"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns, in order, are cut into spans by the prefix sums of
their tokens.  What a window repeats is charged to the budget first: the room of
a span is the budget less the system turn's tokens and ``history_budget``.  A
turn of more than half the room is a span of its own, the others share a span
while their running sums fall in the same stretch of half the room, so that no
span of several turns exceeds the room.  A window is a span with what it needs
to stand alone: the conversation's system turn (its first turn, if of that role
and of at most half the budget; a longer one is not repeated), then at most
``history`` turns from before the span that together have at most
``history_budget`` tokens and leave the window within the budget, then the span.
So a window exceeds the budget only if it is a single turn that is too large,
with no history.  The loss mask holds the texts of the span's assistant turns;
whatever a window repeats is masked, so each assistant text is learnt from once.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Within roles and texts
a backslash becomes two, and ``<|`` becomes ``<\\|``; roles also have their line
breaks written as ``<\\n``.  The formatted text thus holds control strings only
where turns begin and end, and unescaping gives the texts back.

Tokens are counted as a quarter of a text's bytes, rounded up, and 4 for the
marks.  Turns of a conversation are put together by a window over its id, which
Spark sorts with spilling; a window's row holds bounded text.  Only the digest
of a whole conversation puts all of it into one row, as its SHA-256 demands.

Defined cases: a missing text is empty, a missing role the empty role; turns
are ordered by turn (missing first), then role and text, and repeated rows are
turns each; a row without conv_id is a conversation by itself, however many
there are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def tokens(c: Column) -> Column:
    return (F.ceil(F.octet_length(c) / 4) + 4).cast("long")


def _role(c: Column) -> Column:
    return F.replace(escaped(c), F.lit("\n"), F.lit("<\\n"))


def _role_back(c: Column) -> Column:
    return unescaped(F.replace(c, F.lit("<\\n"), F.lit("\n")))


def chat_windows(turns: DataFrame, budget: int = 512, history: int = 2, history_budget: int = 128) -> DataFrame:
    """conv_id, lone, window_no, n_context, tokens, formatted, loss for turns (conv_id, turn, role, text).

    n_context turns at the start are repeated; loss is an array of (start, size)
    in characters of formatted, start from 0; lone tells rows without conv_id apart.
    """
    if budget < 8 or not 0 <= 4 * history_budget <= budget:
        raise ValueError("a budget of 8 tokens and a history of at most a quarter of it are needed")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("lone"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("size", tokens(F.col("text")))
    order = Window.partitionBy("conv_id", "lone").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # what each window has to repeat: the first turn, if it is a system turn that is short enough
    rows = rows.select("*", F.row_number().over(order).alias("at"), F.first(F.when((F.col("role") == "system") & (F.col("size") <= budget // 2), F.col("size")).otherwise(0)).over(so_far).alias("fixed"))
    rows = rows.withColumn("half", F.expr(f"({budget} - fixed - {history_budget}) div 2"))
    large = F.col("size") > F.col("half")
    rows = rows.select(
        "*",
        F.sum("size").over(so_far).alias("upto"),
        F.sum(F.when(large, F.lit(0)).otherwise(F.col("size"))).over(so_far).alias("small_upto"),
        F.sum(F.when(large, F.lit(1)).otherwise(F.lit(0))).over(so_far).alias("larges"),
    )
    # what differs between the spans of neighbours
    mark = F.struct(F.expr("(small_upto - 1) div half").alias("stretch"), "larges", large.alias("large"))
    rows = rows.withColumn("mark", mark).withColumn("new", F.coalesce(F.lag("mark").over(order) != F.col("mark"), F.lit(True)))
    turn = F.struct("role", "text")
    before = order.rowsBetween(-history, -1)
    rows = rows.select(
        "conv_id", "lone", "at", "size", "fixed", turn.alias("own"),
        F.sum(F.col("new").cast("int")).over(so_far).alias("window_no"),
        F.when(F.col("new"), F.first(F.when(F.col("fixed") > 0, turn)).over(so_far)).alias("system"),
        F.when(F.col("new"), F.col("upto") - F.col("size")).alias("before"),
        F.when(F.col("new"), F.collect_list(F.struct("at", (F.col("upto") - F.col("size")).alias("from"), "size", "role", "text")).over(before)).alias("past"),
    )
    windows = rows.groupBy("conv_id", "lone", "window_no").agg(
        F.sort_array(F.collect_list(F.struct("at", "own"))).alias("span"), F.max("system").alias("system"), F.max("before").alias("before"), F.max("past").alias("past"), F.sum("size").alias("size"), F.max("fixed").alias("fixed")
    )
    first = F.col("span")[0]["at"]
    windows = windows.withColumn("fixed", F.when(first > 1, F.col("fixed")).otherwise(0))
    # a system turn stands first in any case; it is not history as well
    kept = F.expr(f"filter(past, x -> before - x.from <= least({history_budget}, {budget} - fixed - size) AND NOT (fixed > 0 AND x.at = 1))")
    windows = windows.withColumn("past", kept).select(
        "conv_id", "lone", "window_no",
        F.concat(
            F.when(F.col("fixed") > 0, F.array("system")).otherwise(F.expr("array()")),
            F.transform("past", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))),
        ).alias("context"),
        F.transform("span", lambda x: x["own"]).alias("span"),
        (F.col("size") + F.col("fixed") + F.expr("aggregate(past, 0L, (s, x) -> s + x.size)")).alias("tokens"),
    )
    head = lambda x: F.concat(F.lit(START), _role(x["role"]), F.lit("\n"))
    part = lambda x, loss: F.struct(head(x).alias("head"), escaped(x["text"]).alias("body"), loss.alias("loss"))
    parts = F.concat(F.transform("context", lambda x: part(x, F.lit(False))), F.transform("span", lambda x: part(x, x["role"] == "assistant")))
    windows = windows.select("conv_id", "lone", "window_no", F.size("context").alias("n_context"), "tokens", parts.alias("parts"))
    spans = F.expr(
        f"""aggregate(parts, named_struct('at', 0, 'spans', cast(array() AS array<struct<start:int,size:int>>)),
        (s, x) -> named_struct('at', s.at + length(x.head) + length(x.body) + {len(END)},
        'spans', if(x.loss, array_append(s.spans, named_struct('start', s.at + length(x.head), 'size', length(x.body))), s.spans)), s -> s.spans)"""
    )
    formatted = F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    return windows.select("conv_id", "lone", "window_no", "n_context", "tokens", formatted.alias("formatted"), spans.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, lone, window_no, turns (role, text) without the repeated ones, and learnt (the texts under the loss mask)."""
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda x, i: i > F.col("n_context"))
    turn = lambda x: F.struct(
        _role_back(F.substring_index(x, "\n", 1)).alias("role"),
        unescaped(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x) - F.length(F.substring_index(x, "\n", 1)) - 1 - len(END))).alias("text"),
    )
    learnt = F.transform("loss", lambda x: unescaped(F.substring(F.col("formatted"), x["start"] + 1, x["size"])))
    return windows.select("conv_id", "lone", "window_no", F.transform(pieces, turn).alias("turns"), learnt.alias("learnt"), F.length("formatted").cast("long").alias("chars"))


def chat_digest(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the formatted windows alone."""
    read = read_back(windows).select(
        "conv_id", "lone", "window_no", F.size("turns").alias("n"), "chars",
        F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("learnt", "").alias("learnt"),
    )
    whole = read.groupBy("conv_id", "lone").agg(F.sum("n").cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("window_no", "said", "learnt"))).alias("parts"))
    whole = whole.select("conv_id", "n_turns", "formatted_chars", F.array_join(F.col("parts.said"), "").alias("said"), F.array_join(F.col("parts.learnt"), "").alias("learnt"))
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
