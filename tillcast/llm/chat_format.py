"""Conversations as budgeted training windows with a loss mask.

Prefix sums of turn tokens choose spans of whole turns: a window takes new turns while they fit the budget. Each window
begins with the system turn, repeats a limited history of earlier turns, and then holds its new turns. Only assistant texts
among the new turns are loss targets, so every one is a target exactly once and a repeated one is masked.

Control strings inside texts are escaped so that no text can end a turn or begin one, and so that the text can be read
back. Everything is DataFrame operations. A conversation of few turns is one row. In a long one, turns stay rows: sums come
from blocks of rows, the next window's begin from a merge with those sums, the begins in use from pointer doubling. Only
the digests of ``read_back`` need a whole conversation in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import stage

START, END = "<|im_start|>", "<|im_end|>\n"
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]"
#: What the common chat templates treat as control strings: their opening character is escaped.
_OPENS_TAG, _OPENS_INST = r"<(?=\||/?s>|</?SYS>>)", r"\[(?=/?INST\])"


@dataclass(frozen=True)
class ChatSpec:
    """``budget``: tokens of a window. ``history``: at most so many of them repeat earlier turns.

    ``long_turns``, ``long_chars``: beyond either a conversation is worked on as rows; the windows are the same.
    """

    budget: int = 512
    history: int = 128
    long_turns: int = 10_000
    long_chars: int = 1 << 22


#: Sums and positions that meet in one task of a merge.
WIDE = 1 << 16


def escape(text: Column) -> Column:
    """Backslash as \\0, the opening < of a control string as \\1, its opening [ as \\2. Other characters stay."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\0"))
    return F.regexp_replace(F.regexp_replace(doubled, _OPENS_TAG, r"\\1"), _OPENS_INST, r"\\2")


def unescape(text: Column) -> Column:
    for code, plain in (("\\2", "["), ("\\1", "<"), ("\\0", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\3"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\3"), F.lit("\n")))


def turn_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text. Nulls are empty texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))


def _tokens() -> Column:
    return F.regexp_count("text", F.lit(TOKEN)).alias("tokens")


def conversation_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turns: array of (turn, role, text, tokens) in order of turn, then role and text."""
    one = F.struct("turn", "role", "text", _tokens())
    return turns.select("conv_id", one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), _escape_role(role), F.lit("\n"))


def windows(turns: DataFrame, spec: ChatSpec = ChatSpec()) -> DataFrame:
    """conv_id, window, repeated, formatted, loss for rows (conv_id, turn, role, text).

    ``formatted``: the text of the window. ``repeated``: its first turns that earlier windows held (system turn and
    history). ``loss``: array of (start, length) of the code points under the loss mask, start counted from 1. A turn that
    alone exceeds the budget has a window of its own, uncut. The system turn is the first turn if its role is ``system``.
    """
    rows = turn_rows(turns)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text").cast("bigint")).alias("chars"))
    long = sizes.where((F.col("n") > spec.long_turns) | (F.col("chars") > spec.long_chars))
    long = stage(long.select(F.col("conv_id").alias("long_id"), F.monotonically_increasing_id().alias("key")), "long-conversations")
    if long.isEmpty():
        return _short_windows(rows, spec)
    same = rows["conv_id"].eqNullSafe(long["long_id"])
    found = _long_windows(rows.join(long, same), spec).join(long, "key").withColumnRenamed("long_id", "conv_id")
    return _short_windows(rows.join(long, same, "left_anti"), spec).unionByName(found.drop("key"))


def _short_windows(turns: DataFrame, spec: ChatSpec) -> DataFrame:
    """``windows`` of conversations that are one row each."""
    rows = conversation_rows(turns)
    has_system = (F.get(F.col("turns"), F.lit(0))["role"] == "system").cast("int")
    rows = rows.withColumn("first", has_system).withColumn("tokens", F.transform("turns", lambda t: t["tokens"]))
    rows = rows.withColumn("system_tokens", F.when(F.col("first") == 1, F.get("tokens", F.lit(0))).otherwise(0))
    # Tokens of the turns before each turn; the history of a window reaches back while it fits its share.
    empty = F.array().cast("array<bigint>")
    sums = F.aggregate(
        "tokens",
        F.struct(F.lit(0).cast("bigint").alias("sum"), empty.alias("before")),
        lambda s, t: F.struct((s["sum"] + t).alias("sum"), F.concat(s["before"], F.array(s["sum"])).alias("before")),
    )
    rows = rows.withColumn("sums", sums).withColumn("before", F.concat("sums.before", F.array("sums.sum")))

    def back(at: Column) -> Column:
        """The first turn of the history of a window whose new turns begin at ``at``."""
        reach = F.get("before", at) - spec.history
        return F.greatest(F.col("first"), F.least(at, F.size(F.filter("before", lambda b: b < reach))))

    # A new window begins where a turn no longer fits: system turn, history and new turns up to it are over the budget.
    def place(state: Column, at: Column) -> Column:
        used = F.col("system_tokens") + F.get("before", at + 1) - state["from"]
        begins = (at > state["begin"]) & (used > spec.budget)
        return F.when(
            begins,
            F.struct(at.alias("begin"), F.get("before", back(at)).alias("from"), F.concat(state["spans"], F.array(F.struct(at.alias("begin"), back(at).alias("back")))).alias("spans")),
        ).otherwise(state)

    # The system turn belongs to the first window and takes its tokens once.
    start = F.struct(
        F.lit(0).alias("begin"),
        F.col("system_tokens").cast("bigint").alias("from"),
        F.array(F.struct(F.lit(0).alias("begin"), F.lit(0).alias("back"))).alias("spans"),
    )
    spans = F.aggregate(F.sequence(F.lit(0), F.size("turns") - 1), start, place, lambda s: s["spans"])
    rows = rows.select("conv_id", "turns", "first", spans.alias("spans"))
    # There is always a window; the outer form keeps the optimizer from working out the spans a second time in a filter.
    rows = rows.select("conv_id", "turns", "first", "spans", F.posexplode_outer("spans").alias("window", "span"))
    end = F.coalesce(F.get("spans", F.col("window") + 1)["begin"], F.size("turns"))
    history = F.slice(F.col("turns"), F.col("span.back") + 1, F.col("span.begin") - F.col("span.back"))
    system = F.when(F.col("span.begin") > 0, F.slice(F.col("turns"), F.lit(1), F.col("first"))).otherwise(F.slice(F.col("turns"), F.lit(1), F.lit(0)))
    new = F.slice(F.col("turns"), F.col("span.begin") + 1, end - F.col("span.begin"))
    shown = F.transform(
        F.concat(system, history, new),
        lambda t, i: F.struct(
            _head(t["role"]).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("target"),
            i.alias("i"),
        ),
    )
    rows = rows.select("conv_id", "window", (F.size(system) + F.size(history)).alias("repeated"), shown.alias("shown"))
    formatted = F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    masks = F.aggregate(
        "shown",
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("loss")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(
                t["target"] & (t["i"] >= F.col("repeated")),
                F.concat(s["loss"], F.array(F.struct((s["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))),
            )
            .otherwise(s["loss"])
            .alias("loss"),
        ),
        lambda s: s["loss"],
    )
    return rows.select("conv_id", "window", "repeated", formatted.alias("formatted"), masks.alias("loss"))


def _nearest(points: DataFrame, queries: DataFrame) -> DataFrame:
    """``queries`` with ``hit``: of ``points`` (key, value, pos) with the key, the greatest (value, pos) of value at most
    ``value``; null if there is none."""
    point = F.struct("value", "pos")
    other = queries.withColumn("point", F.lit(None).cast("struct<value: bigint, pos: bigint>"))
    rows = points.select("key", "value", point.alias("point")).unionByName(other, allowMissingColumns=True).withColumn("asks", F.col("point").isNull())
    rows = rows.withColumn("block", F.floor(F.col("value") / WIDE))
    so_far = Window.partitionBy("key", "block").orderBy("value", "asks").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("key", "block").agg(F.max("point").alias("most")).select("key", "block", F.max("most").over(earlier).alias("carried"))
    found = rows.withColumn("own", F.max("point").over(so_far)).where("asks").join(carried, ["key", "block"])
    return found.select(*queries.columns, F.coalesce("own", "carried").alias("hit"))


def _sums(ordered: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``ordered`` turns: key, pos, role, text with the place in the conversation; key, pos, before with the tokens before
    the turn; and a row per conversation: key, n, total, first, system_tokens."""
    blocks = ordered.groupBy("key", "block").agg(F.min("at").alias("at0"), F.count("*").alias("n"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("key", "block", "at0", "n", "t", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("n", "t")))
    blocks = stage(blocks, "chat-blocks")
    so_far = Window.partitionBy("key", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = ordered.select("key", "block", "at", "tokens", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)).alias("in_block"))
    place = (F.col("n0") + F.col("at") - F.col("at0")).alias("pos")
    sums = rows.join(blocks, ["key", "block"]).select("key", place, (F.col("t0") + F.col("in_block")).alias("before"))
    opening = F.min_by(F.struct((F.col("role") == "system").cast("int").alias("first"), "tokens"), "at").alias("opening")
    begins = ordered.groupBy("key").agg(opening, F.count("*").alias("n"), F.sum("tokens").alias("total"))
    system_tokens = F.when(F.col("opening.first") == 1, F.col("opening.tokens")).otherwise(0).cast("bigint")
    conversations = begins.select("key", "n", "total", F.col("opening.first").alias("first"), system_tokens.alias("system_tokens"))
    texts = ordered.join(blocks.select("key", "block", "at0", "n0"), ["key", "block"]).select("key", place, "role", "text")
    return texts, stage(sums, "chat-sums"), stage(conversations, "chat-conversations")


def _pointers(sums: DataFrame, conversations: DataFrame, spec: ChatSpec) -> DataFrame:
    """key, pos, back, next: were a window to begin at ``pos``, where its history and the window after it begin."""
    points = sums.unionByName(conversations.select("key", F.col("n").alias("pos"), F.col("total").alias("before")))
    # Turns without tokens share a sum: one row for each sum.
    values = stage(points.groupBy("key", F.col("before").alias("value")).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")), "chat-values")
    # The least sum that is at least some value is the greatest of the negated sums that are at most the negated value.
    negated = values.select("key", (-F.col("value")).alias("value"), (-F.col("lo")).alias("pos"))
    asked = values.select("key", F.col("value").alias("before"), (spec.history - F.col("value")).alias("value"))
    reach = _nearest(negated, asked).join(conversations, "key")
    back = F.greatest(F.col("first").cast("bigint"), -F.col("hit.pos"))
    begin = F.greatest(F.col("system_tokens"), -F.col("hit.value"))
    reach = reach.select("key", "before", back.alias("back"), (spec.budget - F.col("system_tokens") + begin).alias("value"))
    # The system turn belongs to the first window and takes its tokens once.
    opening = conversations.select("key", F.lit(-1).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("back"), F.lit(spec.budget).cast("bigint").alias("value"))
    ends = _nearest(values.select("key", "value", F.col("hi").alias("pos")), reach.unionByName(opening))
    ends = ends.select("key", "before", "back", F.col("hit.pos").alias("fits"))
    own = sums.withColumn("before", F.when(F.col("pos") == 0, -1).otherwise(F.col("before")))
    return own.join(ends, ["key", "before"]).select("key", "pos", "back", F.greatest(F.col("pos") + 1, "fits").alias("next"))


def _begins(pointers: DataFrame) -> DataFrame:
    """key, window, pos of the windows reached from the first turn on, by jumps of 1, 2, 4, ... windows."""
    reached = pointers.where("pos = 0").select("key", F.lit(0).alias("window"), "pos")
    jumps, step = pointers.select("key", "pos", "next"), 1
    while True:
        landed = reached.join(jumps, ["key", "pos"]).select("key", (F.col("window") + step).alias("window"), F.col("next").alias("pos"))
        # The jump beyond the last turn meets no turn.
        landed = stage(landed.join(pointers.select("key", "pos"), ["key", "pos"], "left_semi").select("key", "window", "pos"), "chat-begins")
        if landed.isEmpty():
            return reached
        reached = reached.unionByName(landed)
        onward = jumps.select("key", F.col("pos").alias("next"), F.col("next").alias("beyond"))
        jumps = stage(jumps.join(onward, ["key", "next"]).select("key", "pos", F.col("beyond").alias("next")), "chat-jumps")
        step *= 2


def _long_windows(turns: DataFrame, spec: ChatSpec) -> DataFrame:
    """key, window, repeated, formatted, loss for turns with the key of their conversation; no conversation is one row."""
    # Ranges of the order of turns, so that a long conversation is in many tasks; the written row numbers hold.
    ranges = turns.repartitionByRange("key", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("key", "turn", "role", "text")
    ordered = ranges.select("key", "role", "text", _tokens(), F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("block"))
    texts, sums, conversations = _sums(stage(ordered, "chat-turns"))
    pointers = stage(_pointers(sums, conversations, spec), "chat-pointers")
    spans = _begins(pointers).join(pointers, ["key", "pos"]).join(conversations.select("key", "first"), "key")
    later = F.col("window") > 0
    system = F.when(later, F.col("first")).otherwise(0)
    repeated = F.when(later, F.col("first") + F.col("pos") - F.col("back")).otherwise(0).cast("int")
    spans = stage(spans.select("key", "window", "back", "next", system.alias("system"), repeated.alias("repeated")), "chat-spans")
    shown = spans.select("key", "window", "repeated", "system", F.posexplode(F.sequence("back", F.col("next") - 1)).alias("i", "pos"))
    shown = shown.join(texts, ["key", "pos"]).select("key", "window", "repeated", (F.col("i") + F.col("system")).alias("i"), "role", "text")
    # The system turn stands in every window: one row per conversation, not one hot place.
    opening = stage(texts.join(conversations.where("first = 1"), "key", "left_semi").where("pos = 0").select("key", "role", "text"), "chat-system")
    shown = shown.unionByName(spans.where("system = 1").join(opening, "key").select("key", "window", "repeated", F.lit(0).alias("i"), "role", "text"))
    rows = shown.select("key", "window", "repeated", "i", _head(F.col("role")).alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("target"))
    before = Window.partitionBy("key", "window").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + len(END)
    start = (F.coalesce(F.sum(length).over(before), F.lit(0)) + F.length("head") + 1).cast("int")
    loss = F.when(F.col("target") & (F.col("i") >= F.col("repeated")), F.struct(start.alias("start"), F.length("body").alias("length")))
    rows = rows.select("key", "window", "repeated", F.struct("i", F.concat("head", "body", F.lit(END)).alias("said"), loss.alias("loss")).alias("one"))
    rows = rows.groupBy("key", "window").agg(F.first("repeated").alias("repeated"), F.sort_array(F.collect_list("one")).alias("ones"))
    return rows.select("key", "window", "repeated", F.array_join("ones.said", "").alias("formatted"), F.filter("ones.loss", F.isnotnull).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from windows alone.

    Turns are found by the template's marks and unescaped; those a window repeats are skipped. Digests are over role,
    line feed, text, line feed of each turn, and over all text under the loss mask.
    """
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    bodies = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - 1 - F.col("repeated"))

    def plain(piece: Column) -> Column:
        said = F.substr(piece, F.lit(len(START) + 1))
        cut = F.instr(said, "\n")
        return F.concat(_unescape_role(F.substr(said, F.lit(1), cut - 1)), F.lit("\n"), unescape(F.substr(said, cut + 1)), F.lit("\n"))

    masked = F.transform("loss", lambda m: unescape(F.substr(F.col("formatted"), m["start"], m["length"])))
    one = F.struct("window", F.array_join(F.transform(bodies, plain), "").alias("turns"), F.array_join(masked, "").alias("loss"))
    read = formatted.select("conv_id", F.size(bodies).alias("n"), F.length("formatted").alias("chars"), one.alias("one"))
    whole = read.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("one")).alias("ones"))
    turns, loss = (F.array_join(F.transform("ones", lambda w: w[part]), "") for part in ("turns", "loss"))
    return whole.select("conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
