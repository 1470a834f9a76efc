"""Chat formatting in budgeted windows (DataFrame operations only).

Sums of turn tokens (words) cut a conversation into spans of whole turns.  A window is its span, preceded by turns
repeated from the span before it (the last ``HISTORY`` tokens at most) and by the conversation's opening system
turn.  The budget holds for all of it: a span closes before the turn that would take the window over, with room kept
for the system turn and the history from the second span on.  Only a turn that is longer than the budget by itself
makes a longer window, alone.  Beside a long turn, history is repeated as far as there is room, and the system turn if it
fits; a system turn of more than half of the budget less the history stands in the first window only.  No turn is
cut.  The loss mask covers the assistant texts of the span, never those repeated.

Template: ``<s>[INST]role[/INST]text</s>`` for each turn.  Inside roles and texts, a backslash is
put behind the first character of every control string (and of its forms that have
backslashes there already), so an unescaped control string only ever comes from the
template, and ``unescape`` takes exactly one backslash away.

Null roles, texts and turns count as empty (a null turn sorts first).  Equal turns order by
role and text.  Rows with a null ``conv_id`` form one conversation.  Windows of a conversation are
built by window functions over its turns; a turn sees the token counts of ``CHAPTER`` turns at most (a span also
closes at the end of a chapter).  ``read_back`` joins the texts of a conversation for its digest into one value, so
conversations (and the rows without an id together) of more than 2 GB cannot be read back; ``windows`` can form them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 384            # tokens of a window
HISTORY = 128           # tokens of repeated turns; at most BUDGET
CHAPTER = 256           # turns after which a span closes at the latest
BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
# What follows the first character of a control string.
_REST = r"(?:/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(?=\\*" + _REST + ")", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(?=\\*" + _REST + ")", "$1")


def turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id``, ``window`` (in order), ``formatted``, ``n_repeated`` (leading turns that
    are context) and ``loss`` (start and length, in code points, of each span under the mask)."""
    if not 0 <= history <= budget:
        raise ValueError("history must be between 0 and the budget")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tokens = F.greatest(F.lit(1), F.regexp_count("text", F.lit(r"\S+"))).cast("long")
    first = F.first(F.struct("role", "text", "_tokens")).over(upto)
    placed = (turns(conversations).withColumn("_tokens", tokens).withColumn("_n", F.row_number().over(order))
              .withColumn("_end", F.sum("_tokens").over(upto)).withColumn("_first", first))
    # Tokens of the system turn, where later windows repeat it, and what these have for new turns.
    repeats = (F.col("_first.role") == "system") & (F.col("_first._tokens") <= (budget - history) // 2)
    placed = (placed.withColumn("_system", F.when(repeats, F.col("_first._tokens")).otherwise(F.lit(0).cast("long")))
              .withColumn("_chapter", F.floor((F.col("_n") - 1) / CHAPTER)))
    chapter = Window.partitionBy("conv_id", "_chapter").orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = lambda span: F.when((F.col("_chapter") == 0) & (span == 0), F.lit(budget)).otherwise(
        F.lit(budget - history) - F.col("_system"))
    spanned = F.aggregate(
        F.collect_list("_tokens").over(chapter),
        F.struct(F.lit(0).cast("long").alias("span"), F.lit(0).cast("long").alias("used")),
        lambda at, n: F.when((at["used"] > 0) & (at["used"] + n > room(at["span"])),
                             F.struct((at["span"] + 1).alias("span"), n.alias("used")))
        .otherwise(F.struct(at["span"].alias("span"), (at["used"] + n).alias("used"))))
    placed = placed.withColumn("_span", (F.col("_chapter") * CHAPTER + spanned["span"]).cast("long"))
    whole_span = Window.partitionBy("conv_id", "_span")
    placed = placed.withColumn("_free", F.lit(budget) - F.sum("_tokens").over(whole_span))
    # The next span, the room that it leaves for history, and the tokens from a turn to the end of its own span.
    later = Window.partitionBy("conv_id").orderBy("_span").rangeBetween(1, Window.unboundedFollowing)
    placed = (placed.withColumn("_next", F.min(F.struct("_span", "_free")).over(later))
              .withColumn("_left", F.max("_end").over(whole_span) - F.col("_end") + F.col("_tokens"))
              .withColumn("_begins", F.coalesce(F.lag("_span").over(order) != F.col("_span"), F.lit(True))))
    fits = lambda free: F.when(free >= F.col("_system"), F.col("_system")).otherwise(0)
    next_free = F.col("_next._free")
    piece = lambda role, text, n, repeated: F.struct(
        n.cast("long").alias("n"), escape(role).alias("role"), escape(text).alias("text"), F.lit(repeated).alias("repeated"),
        (F.lit(not repeated) & (role == "assistant")).alias("target"))
    own = F.struct(F.col("_span").alias("span"), piece(F.col("role"), F.col("text"), F.col("_n"), False).alias("p"))
    again = F.when(F.col("_next").isNotNull() & (F.col("_left") <= F.least(F.lit(history), next_free - fits(next_free)))
                   & ~((F.col("_n") == 1) & (F.col("_system") > 0)),
                   F.struct(F.col("_next._span").alias("span"), piece(F.col("role"), F.col("text"), F.col("_n"), True).alias("p")))
    opening = F.when(F.col("_begins") & (F.col("_n") > 1) & (F.col("_system") > 0) & (F.col("_system") <= F.col("_free")),
                     F.struct(F.col("_span").alias("span"), piece(F.col("_first.role"), F.col("_first.text"), F.lit(0), True).alias("p")))
    parts = placed.select("conv_id", F.explode(F.array_compact(F.array(own, again, opening))).alias("_w")).select(
        "conv_id", "_w.span", "_w.p")
    grouped = parts.groupBy("conv_id", "span").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    lead = lambda p: F.concat(F.lit(BEGIN + OPEN), p["role"], F.lit(CLOSE))
    whole = lambda p: F.concat(lead(p), p["text"], F.lit(END))
    walked = F.aggregate(
        F.col("ps"),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,len:bigint>>").alias("loss")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(whole(p))).alias("at"),
            F.when(p["target"], F.concat(acc["loss"], F.array(F.struct(
                (acc["at"] + F.length(lead(p))).alias("start"), F.length(p["text"]).cast("long").alias("len")))))
            .otherwise(acc["loss"]).alias("loss")))
    return grouped.select(
        "conv_id", F.col("span").alias("window"), F.concat_ws("", F.transform("ps", whole)).alias("formatted"),
        F.size(F.filter("ps", lambda p: p["repeated"])).alias("n_repeated"), walked["loss"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: the number and digest of its turns, the
    characters and digest of the text under the loss mask, and the formatted characters."""
    pieces = F.slice(F.split("formatted", END, -1), F.col("n_repeated") + 1,
                     F.greatest(F.lit(0), F.size(F.split("formatted", END, -1)) - 1 - F.col("n_repeated")))
    lead = len(BEGIN + OPEN)
    role = lambda p: F.substring_index(F.substring(p, lead + 1, 2**31 - 1), CLOSE, 1)
    text = lambda p: p.substr(F.length(role(p)) + lead + len(CLOSE) + 1, F.length(p))
    read = formatted.select(
        "conv_id", "window", F.length("formatted").cast("long").alias("chars"),
        F.transform(pieces, lambda p: F.concat(unescape(role(p)), F.lit("\n"), unescape(text(p)), F.lit("\n"))).alias("turns"),
        F.concat_ws("", F.transform("loss", lambda s: unescape(
            F.col("formatted").substr(s["start"].cast("int") + 1, s["len"].cast("int"))))).alias("target"))
    each = read.select("conv_id", "chars", F.struct(
        "window", F.size("turns").alias("n"), F.concat_ws("", "turns").alias("turns"), "target").alias("w"))
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"), F.sum("chars").alias("chars"))
    joined = lambda field: F.concat_ws("", F.transform("ws", lambda w: w[field]))
    return whole.select(
        "conv_id", F.aggregate("ws", F.lit(0).cast("long"), lambda n, w: n + w["n"]).alias("n_turns"),
        F.sha2(F.encode(joined("turns"), "UTF-8"), 256).alias("turns_sha256"),
        F.length(joined("target")).cast("long").alias("loss_chars"),
        F.sha2(F.encode(joined("target"), "UTF-8"), 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"))
