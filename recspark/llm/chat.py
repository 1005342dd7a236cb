"""Chat formatting into budgeted windows, with a reversible template.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and
texts every ``<``, backslashes, ``|`` gets one more backslash, so no text can
hold a control string, and taking one backslash away restores it.  A line break
in a role is written as ``<\\n|``.

Windows are spans of whole turns.  Prefix sums of the turns' tokens in a chunk
find where the first window begins, a running sum follows those after it:
a window begins with the conversation's leading system turn, then the last
``history_turns`` turns before the span as far as they fit into
``history_tokens`` and the budget, then new turns up to the budget.  Loss spans
cover the texts of new assistant turns, so repeated ones are masked.  A turn
larger than the budget gets a window of its own, marked ``over_budget``.

Turns stay rows of their own: they are numbered by range partitions, chunks of
them carry prefix sums, and a chunk's rule says which window is open behind it
for any one open before, so a conversation may have any number of turns.  Only
a window, and in ``read_windows`` a conversation, is one row.

Defined results: turns are ordered by turn, role and text, nulls first; a null
role or text is empty; rows with a null ``conv_id`` are one conversation; equal
rows are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
BYTES_PER_TOKEN = 4
#: Tokens of a turn's frame: both marks, the role and two line breaks.
FRAME_TOKENS = 5
#: Turns of a chunk and chunks of a group, as powers of two.
CHUNK_BITS, GROUP_BITS = 7, 10
_RULE = "array<struct<t:bigint,used:bigint,n:bigint>>"
_SHOWN = "array<struct<w:bigint,m:bigint,old:array<bigint>>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    # "<n|" stands for a line break; a "<n|" of the role itself gets a backslash.
    kept = F.regexp_replace(escape(role), r"<(\\*)n\|", r"<\\$1n|")
    return F.regexp_replace(kept, "\n", "<n|")


def unescape_role(role: Column) -> Column:
    back = F.regexp_replace(role, r"<n\|", "\n")
    return unescape(F.regexp_replace(back, r"<\\(\\*)n\|", r"<$1n|"))


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn, estimated from the bytes of its text."""
    return (F.ceil(F.octet_length(text) / F.lit(BYTES_PER_TOKEN)) + FRAME_TOKENS).cast("long")


def _turns(turns: DataFrame) -> DataFrame:
    """m, conv_id, role, text and tokens of each turn; m numbers all turns of
    all conversations in their order, with gaps between range partitions."""
    empty = F.lit("")
    keys = ["conv_id", "turn", "role", "text"]
    # The last key spreads equal rows.
    ranged = (turns.select(*keys, F.monotonically_increasing_id().alias("row"))
              .repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row"))
    text = F.coalesce("text", empty)
    return materialize(ranged.select(
        F.monotonically_increasing_id().alias("m"), "conv_id",
        F.coalesce("role", empty).alias("role"), text.alias("text"),
        turn_tokens(text).alias("tokens")), "chat-turns")


def _chunks(turns: DataFrame, budget: int, history_turns: int, history_tokens: int) -> DataFrame:
    """One row per chunk of up to CHUNK turns of a conversation: k (its first
    m), m0 (the conversation's first m), b: array of (m, tokens, upto, base,
    old) in order.

    ``upto`` is the prefix sum of tokens in the chunk, the turn among them;
    ``base`` the tokens that a window repeats if it begins with the turn, and
    ``old`` the m of the repeated turns.
    """
    one = F.struct("m", "tokens", (F.col("role") == "system").alias("sys"))
    chunks = materialize(
        turns.groupBy("conv_id", F.shiftright("m", CHUNK_BITS).alias("c"))
        .agg(F.array_sort(F.collect_list(one)).alias("a"))
        .select("conv_id", F.col("a")[0]["m"].alias("k"), "a"), "chat-chunks")
    some = max(history_turns, 1)
    in_order = W.partitionBy("conv_id").orderBy("k")
    tail = F.slice("a", F.greatest(F.size("a") - some + 1, F.lit(1)), some)
    # Every chunk has a turn: as many chunks as turns of history are enough.
    around = (chunks.select("conv_id", "k", F.col("a")[0].alias("head"), tail.alias("tail"))
              .select("k", F.first("head").over(in_order).alias("head"),
                      F.flatten(F.collect_list("tail").over(in_order.rowsBetween(-some, -1)))
                      .alias("before")))
    whole = (chunks.select("k", "a").join(around, "k")
             .withColumn("m0", F.col("head.m"))
             .withColumn("low", F.when(F.col("head.sys"), F.col("m0") + 1).otherwise(F.col("m0")))
             .withColumn("st", F.when(F.col("head.sys"), F.col("head.tokens"))
                         .otherwise(F.lit(0).cast("long")))
             .withColumn("all", F.concat("before", "a"))
             .withColumn("off", F.size("before")))
    system = F.filter(F.array("m0"), lambda m: F.col("head.sys"))
    none = F.struct(F.col("st").alias("base"), system.alias("old"))

    def begins(x: Column, j: Column) -> Column:
        total, ids, best = F.col("st"), system, none
        for n in range(1, history_turns + 1):
            y = F.get("all", F.col("off") + j - n)
            total = total + y["tokens"]
            ids = F.concat(ids, F.array(y["m"]))
            fits = ((y["m"] >= F.col("low")) & (total - F.col("st") <= history_tokens)
                    & (total + x["tokens"] <= budget))
            best = F.when(fits, F.struct(total.alias("base"), ids.alias("old"))).otherwise(best)
        return best

    b = F.transform("a", lambda x, j: F.struct(x["m"].alias("m"), x["tokens"].alias("tokens"),
                                               begins(x, j).alias("h")))
    sums = F.aggregate("b", F.expr("cast(array() as array<bigint>)"), lambda acc, x: F.concat(
        acc, F.array(x["tokens"] + F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)))))
    b2 = F.zip_with("b", "sums", lambda x, s: F.struct(
        x["m"].alias("m"), x["tokens"].alias("tokens"), s.alias("upto"),
        x["h"]["base"].alias("base"), x["h"]["old"].alias("old")))
    return materialize(whole.select("k", "m0", b.alias("b")).withColumn("sums", sums)
                       .select("k", "m0", b2.alias("b")), "chat-prefix")


def _walk(b: Column, m0: Column, budget: int, used: Column) -> Column:
    """(used, n) after the turns of ``b``: the open window's tokens and the
    number of windows begun, with ``used`` tokens before."""
    zero = F.struct(used.cast("long").alias("used"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        opens = (x["m"] > m0) & (acc["used"] + x["tokens"] > budget)
        return F.struct((F.when(opens, x["base"]).otherwise(acc["used"]) + x["tokens"]).alias("used"),
                        (acc["n"] + F.when(opens, 1).otherwise(0)).cast("long").alias("n"))
    return F.aggregate(b, zero, step)


def _after(rule: Column, total: Column, used: Column) -> Column:
    """(used, n) behind a part with ``used`` tokens before it.

    ``rule`` holds (t, used, n) with falling t: the first one with a t below
    the tokens before holds; without any the part begins no window.
    """
    r = F.get(F.filter(rule, lambda x: used > x["t"]), F.lit(0))
    return F.struct(F.coalesce(r["used"], used + total).alias("used"),
                    F.coalesce(r["n"], F.lit(0).cast("long")).alias("n"))


def _shorten(rule: Column) -> Column:
    """Without the entries that no number of tokens reaches."""
    return F.filter(rule, lambda x, i: (i == 0) | (F.get(rule, i - 1)["t"] >= 0))


def _join_rules(parts: Column) -> Column:
    """(rule, total) of an array of parts in order."""
    def step(acc: Column, x: Column) -> Column:
        def through(y: Column) -> Column:
            z = _after(x["rule"], x["total"], y["used"])
            return F.struct(y["t"].alias("t"), z["used"].alias("used"),
                            (y["n"] + z["n"]).alias("n"))
        later = F.transform(x["rule"], lambda y: F.struct(
            (y["t"] - acc["total"]).alias("t"), y["used"].alias("used"), y["n"].alias("n")))
        both = F.concat(F.transform(acc["rule"], through), later)
        return F.struct(_shorten(both).alias("rule"), (acc["total"] + x["total"]).alias("total"))
    zero = F.struct(F.expr(f"cast(array() as {_RULE})").alias("rule"),
                    F.lit(0).cast("long").alias("total"))
    return F.aggregate(parts, zero, step)


def _before_each(parts: Column, used: Column, w: Column) -> Column:
    """Array of (k, used, w): the tokens and the window before each part."""
    zero = F.struct(used.alias("used"), w.alias("w"), F.expr(
        "cast(array() as array<struct<k:bigint,used:bigint,w:bigint>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        z = _after(x["rule"], x["total"], acc["used"])
        here = F.struct(x["k"].alias("k"), acc["used"].alias("used"), acc["w"].alias("w"))
        return F.struct(z["used"].alias("used"), (acc["w"] + z["n"]).alias("w"),
                        F.concat(acc["out"], F.array(here)).alias("out"))
    return F.aggregate(parts, zero, step, lambda acc: acc["out"])


def _members(chunks: DataFrame, budget: int) -> DataFrame:
    """(m, window, new) of every turn in every window that shows it.

    A chunk's rule says how it ends for any number of tokens before it.  Rules
    of chunks are joined to those of groups; from the start of a conversation
    the tokens before each group, then before each chunk, follow.
    """
    first = F.col("k") == F.col("m0")
    entries = F.filter("b", lambda x: x["upto"] - x["tokens"] <= budget)
    rule = F.transform(entries, lambda x, j: F.struct(
        (F.lit(budget).cast("long") - x["upto"]).alias("t"),
        _walk(F.slice("b", j + 1, F.size("b")), F.col("m0"), budget, F.lit(budget)).alias("e")))
    rule = F.transform(rule, lambda x: F.struct(
        x["t"].alias("t"), x["e"]["used"].alias("used"), x["e"]["n"].alias("n")))
    start = _walk(F.col("b"), F.col("m0"), budget, F.lit(0))
    start = F.transform(F.array(start), lambda e: F.struct(
        F.lit(-1).cast("long").alias("t"), e["used"].alias("used"), e["n"].alias("n")))
    parts = chunks.select("m0", "k", F.when(first, start).otherwise(rule).alias("rule"),
                          F.element_at("b", -1)["upto"].alias("total"))
    one = F.struct("k", "rule", "total")
    groups = materialize(
        parts.groupBy("m0", F.shiftright("k", CHUNK_BITS + GROUP_BITS).alias("g"))
        .agg(F.array_sort(F.collect_list(one)).alias("parts"))
        .select("m0", F.col("parts")[0]["k"].alias("k"), "parts",
                _join_rules(F.col("parts")).alias("r"))
        .select("m0", "k", "parts", "r.rule", "r.total"), "chat-groups")
    zero = F.lit(0).cast("long")
    heads = (groups.groupBy("m0").agg(F.array_sort(F.collect_list(one)).alias("parts"))
             .select(F.inline(_before_each(F.col("parts"), zero, zero))))
    each = (groups.select("k", "parts").join(heads, "k")
            .select(F.inline(_before_each(F.col("parts"), F.col("used"), F.col("w")))))
    acc = F.struct(F.col("used"), F.col("w"), F.expr(f"cast(array() as {_SHOWN})").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        opens = (x["m"] > F.col("m0")) & (acc["used"] + x["tokens"] > budget)
        w = acc["w"] + F.when(opens, 1).otherwise(0)
        old = F.when(opens, x["old"]).otherwise(F.expr("cast(array() as array<bigint>)"))
        here = F.struct(w.alias("w"), x["m"].alias("m"), old.alias("old"))
        return F.struct((F.when(opens, x["base"]).otherwise(acc["used"]) + x["tokens"]).alias("used"),
                        w.alias("w"), F.concat(acc["out"], F.array(here)).alias("out"))

    shown = (chunks.join(each, "k")
             .select(F.inline(F.aggregate("b", acc, step, lambda a: a["out"]))))
    shows = F.concat(F.array(F.struct("m", F.lit(True).alias("new"))),
                     F.transform("old", lambda m: F.struct(m.alias("m"), F.lit(False).alias("new"))))
    return shown.select(F.col("w").cast("int").alias("window"), F.explode(shows).alias("s")) \
        .select("s.m", "window", "s.new")


def format_windows(turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                   history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row per window: conv_id, window, text, n_repeated, n_turns, tokens,
    over_budget and loss_spans.

    ``loss_spans`` is an array of (start, end) in code points of ``text``, end
    exclusive; ``n_repeated`` is the number of leading turns shown before.
    """
    if history_turns < 0 or budget < 1:
        raise ValueError("budget must be positive, history_turns not negative")
    rows = _turns(turns)
    members = _members(_chunks(rows, budget, history_turns, history_tokens), budget)
    one = F.struct("m", "role", "text", "tokens", "new")
    each = (rows.join(members, "m").groupBy("conv_id", "window")
            .agg(F.array_sort(F.collect_list(one)).alias("t")))
    repeated = F.filter("t", lambda x: ~x["new"])
    fresh = F.filter("t", lambda x: x["new"])

    def segment(x: Column, new: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"))
        body = escape(x["text"])
        return F.struct(head.alias("head"), body.alias("body"), x["tokens"].alias("tokens"),
                        (new & (x["role"] == "assistant")).alias("loss"))

    old = F.transform(repeated, lambda x: segment(x, F.lit(False)))
    new = F.transform(fresh, lambda x: segment(x, F.lit(True)))
    segments = (each.select("conv_id", "window", old.alias("old"), new.alias("new"))
                .select("conv_id", "window", F.size("old").alias("n_repeated"),
                        F.concat("old", "new").alias("s")))

    def advance(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.char_length(x["head"])
        stop = at + F.char_length(x["body"])
        span = F.array(F.struct(at.alias("start"), stop.alias("end")))
        return F.struct((stop + len(END) + 1).alias("at"),
                        F.when(x["loss"], F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    spans = F.aggregate("s", F.struct(F.lit(0).alias("at"), none.alias("spans")), advance,
                        lambda acc: acc["spans"])
    text = F.array_join(F.transform("s", lambda x: F.concat(
        x["head"], x["body"], F.lit(END + "\n"))), "")
    tokens = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return segments.select("conv_id", "window", text.alias("text"), "n_repeated",
                           F.size("s").alias("n_turns"), tokens.alias("tokens"),
                           (tokens > budget).alias("over_budget"), spans.alias("loss_spans"))


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss (array of texts) and
    formatted_chars: the conversations, read back from their windows alone."""
    marked = F.slice(F.split("text", r"<\|im_start\|>", -1), F.col("n_repeated") + 2,
                     F.col("n_turns") - F.col("n_repeated"))

    def parse(seg: Column) -> Column:
        # A segment is role, line break, text, end mark, line break.
        cut = F.instr(seg, "\n")
        return F.struct(
            unescape_role(seg.substr(F.lit(1), cut - 1)).alias("role"),
            unescape(seg.substr(cut + 1, F.char_length(seg) - cut - len(END) - 1)).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(
        F.col("text").substr(s["start"] + 1, s["end"] - s["start"])))
    parts = windows.select("conv_id", "window", F.transform(marked, parse).alias("turns"),
                           loss.alias("loss"), F.char_length("text").cast("long").alias("chars"))
    whole = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"),
        F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", F.flatten("w.turns").alias("turns"),
                        F.flatten("w.loss").alias("loss"), "formatted_chars")


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Counts and digests of conversations read back from their windows."""
    nl = F.lit("\n")
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], nl, x["text"], nl)), "")
    target = F.array_join("loss", "")
    return read_windows(windows).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(target).cast("long").alias("loss_chars"),
        F.sha2(target.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
