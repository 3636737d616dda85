"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written ``<|turn|>role<|text|>text<|end|>``. Control strings inside roles and texts (these marks and those of other
common templates) get a backslash after their first character, and one more where there are some already; taking
one away restores the text, so formatting is reversible whatever a text holds.

Turns are counted in pieces, much as byte-pair vocabularies cut texts: up to eight letters, up to three digits, or one other mark. Prefix
sums of them choose the windows: with ``room`` pieces left after the system turn and the history, turns whose sums begin in the same half of a room make
a span, but a turn longer than half a room is a span of its own. So every window of shorter turns fits the budget; a turn that is
longer than the budget stands alone and whole in a window that exceeds it. Each window but the first repeats the system turn and as
much history as fits ``history_turns`` turns and ``history_tokens`` pieces. Only assistant texts that are new in a window are under the loss
mask, so each of them is a target exactly once.

Places and sums come from buckets of ``BUCKET`` turn numbers: sums of buckets, and places in a bucket. So no task orders a whole conversation, only the list
of its buckets; what looks across a border of buckets is looked up in the next ones' first rows. (Reading a conversation back, by ``read_back``, does gather it in one row.)

Defined cases: a null role or text counts as empty; turns are ordered by (turn, role, text), nulls first, and repeated rows
are turns of their own; a null conv_id is a conversation. The system turn is the first one if its role is
``system``. An empty table gives an empty result. Columns besides the four named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import written

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What may not appear in a text as it is. Everything between the bars, and the marks of other templates.
CONTROL = r"([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|</?SYS>>|/?INST\])"
#: A piece: letters, digits, or one other character that is no white space.
PIECE = r"\p{L}{1,8}|\p{N}{1,3}|[^\p{L}\p{N}\x20\x09-\x0D]"
BUDGET, HISTORY_TURNS, HISTORY_TOKENS, BUCKET = 512, 2, 128, 64


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def tokens(text: Column) -> Column:
    """Pieces of a text, as they are budgeted."""
    return F.regexp_count(text, F.lit(PIECE)).cast("long")


def turns(conversations: DataFrame, budget: int, history_turns: int, history_tokens: int) -> DataFrame:
    """A row for each turn: key, conv, pos, role, piece (formatted), n, window, later (windows that repeat it), is_system, alone.

    window numbers ascend in a conversation, with gaps; the system turn has none.
    """
    conv = F.col("conv_id")
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("null")).alias("key"), conv.alias("conv"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BUCKET).cast("long"), F.lit(-(1 << 62))).alias("bucket"),
    )
    piece = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT), escape(F.col("text")), F.lit(END))
    in_bucket = Window.partitionBy("key", "bucket").orderBy("turn", "role", "text")
    rows = rows.select("*", F.row_number().over(in_bucket).alias("place"), piece.alias("piece")).drop("turn", "text")
    rows = rows.withColumn("n", tokens(F.col("piece")))
    in_bucket = Window.partitionBy("key", "bucket").orderBy("place")
    rows = rows.withColumn("sum", F.sum("n").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = written(rows, "turns")  # read three times below, mostly without the pieces
    first = F.col("place") == 1
    buckets = rows.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"), F.max(F.when(first, F.col("role"))).alias("role"), F.max(F.when(first, F.col("n"))).alias("n"))
    of_key = Window.partitionBy("key").orderBy("bucket")
    before, all_ = of_key.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("key")
    system = F.when(F.first("role").over(of_key) == "system", F.first("n").over(of_key)).otherwise(0)
    buckets = buckets.select(
        "key", "bucket", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("n_before"),
        system.alias("system"), (F.sum("size").over(all_) == 1).alias("alone"),
    )
    rows = rows.join(buckets, ["key", "bucket"]).withColumns({"pos": F.col("rows_before") + F.col("place"), "begin": F.col("n_before") + F.col("sum") - F.col("n")})
    half = F.greatest(F.lit(budget) - F.col("system") - history_tokens, F.lit(16)) / 2
    rows = rows.withColumn("is_system", (F.col("pos") == 1) & (F.col("system") > 0))
    window = F.floor((F.col("begin") - F.col("system")) / half) * 2 + (F.col("n") > half).cast("int")
    rows = rows.withColumn("window", F.when(~F.col("is_system"), window.cast("long")))
    if not history_turns:
        return rows.withColumn("later", F.array().cast("array<bigint>"))
    # history: a turn is repeated in a later window whose start is at most history_turns away, while the pieces from it up to there fit
    step = F.struct("window", "begin")
    heads = rows.where(F.col("place") <= history_turns).groupBy("key", "bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "window", "begin"))), lambda x: F.struct(x["window"].alias("window"), x["begin"].alias("begin"))).alias("head"))
    following = F.flatten(F.filter(F.array(*[F.lead("head", k).over(of_key) for k in range(1, history_turns + 1)]), lambda x: x.isNotNull()))
    rows = rows.join(heads.select(F.col("key"), F.col("bucket"), following.alias("following")), ["key", "bucket"])
    left = F.col("size") - F.col("place")  # turns of the bucket that follow
    ahead = [F.when(left >= k, F.lead(step, k).over(in_bucket)).otherwise(F.try_element_at("following", (F.lit(k) - left).cast("int"))) for k in range(1, history_turns + 1)]
    fits = lambda x: (x["window"] > F.col("window")) & (x["begin"] - F.col("begin") <= history_tokens)
    rows = rows.withColumn("ahead", F.filter(F.array(*ahead), lambda x: x.isNotNull()))
    shown = F.array_distinct(F.transform(F.filter("ahead", fits), lambda x: x["window"]))
    return rows.withColumn("later", shown).drop("ahead", "following")


def format_windows(
    conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS, target: str = "assistant"
) -> DataFrame:
    """A row for each window: conv_id, window, text, repeated (turns at its start that an earlier window has), loss_spans.

    loss_spans: (start, length) of the targets' texts in the window's text, in characters, ordered. window: ascending numbers, with gaps.
    """
    rows = turns(conversations, budget, history_turns, history_tokens).select("key", "conv", "window", "pos", "role", "piece", "later", "is_system", "alone")
    rows = written(rows, "windows")
    shape = ["key", "conv", "window", "kind", "pos", "role", "piece"]
    body = rows.where(~F.col("is_system"))
    new = body.withColumn("kind", F.lit(2))
    old = body.where(F.size("later") > 0).select(F.explode("later").alias("window"), F.lit(1).alias("kind"), "key", "conv", "pos", "role", "piece")
    starts = body.groupBy("key", "window").agg(F.min("pos").alias("start"))
    first = rows.where("is_system")
    # the system turn is new in the first window only
    system = starts.join(first.drop("window"), "key").withColumn("kind", F.when(F.col("start") == 2, 2).otherwise(0))
    only = first.where("alone").withColumns({"window": F.lit(0).cast("long"), "kind": F.lit(2)})
    parts = F.array_sort(F.collect_list(F.struct("kind", "pos", "role", "piece")))
    held = new.select(shape).unionByName(old.select(shape)).unionByName(system.select(shape)).unionByName(only.select(shape)).groupBy("key", "window").agg(F.first("conv").alias("conv"), parts.alias("parts"))
    head = lambda p: F.length(F.lit(TURN + TEXT)) + F.length(escape(p["role"]))
    walk = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["piece"])).alias("at"),
            F.when(
                (p["kind"] == 2) & (p["role"] == target),
                F.concat(s["spans"], F.array(F.struct((s["at"] + head(p)).cast("long").alias("start"), (F.length(p["piece"]) - head(p) - len(END)).cast("long").alias("length")))),
            ).otherwise(s["spans"]).alias("spans"),
        ),
    )
    return held.select(
        F.col("conv").alias("conv_id"),
        F.col("window").cast("long").alias("window"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"),
        F.size(F.filter("parts", lambda p: p["kind"] < 2)).alias("repeated"),
        walk["spans"].alias("loss_spans"),
    )


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> of a window's text."""
    raw = F.slice(F.split(text, r"<\|turn\|>"), 2, 2**30)
    parts = lambda t: F.split(F.substring(t, F.lit(1), F.length(t) - len(END)), r"<\|text\|>")
    return F.transform(F.transform(raw, parts), lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows hold of each conversation: conv_id, turns, target (all text under the loss mask), formatted_chars."""
    own = F.slice(read_turns(F.col("text")), F.col("repeated") + 1, 2**30)
    under = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    rows = windows.select("conv_id", "window", own.alias("turns"), F.array_join(under, "").alias("target"), F.length("text").cast("long").alias("chars"))
    parts = F.array_sort(F.collect_list(F.struct("window", "turns", "target")))
    got = rows.groupBy("conv_id").agg(parts.alias("parts"), F.sum("chars").alias("formatted_chars"))
    return got.select(
        "conv_id",
        F.flatten(F.transform("parts", lambda p: p["turns"])).alias("turns"),
        F.array_join(F.transform("parts", lambda p: p["target"]), "").alias("target"),
        "formatted_chars",
    )
