"""Chat formatting: conversations as windows of a token budget, with a mask of
what a model learns to say.

Method: prefix sums of the turns' tokens choose turn-aligned spans. A window
is the conversation's system turn (a first turn of role ``system``), then
repeated history (the last turns before the span, at most ``HISTORY_TURNS``
of them and ``HISTORY_TOKENS`` tokens), then the span: as many further turns
as the rest of the budget takes. Repeated turns stay outside the loss mask,
so every assistant text is a target exactly once. Spans are chosen greedily
within blocks of ``BLOCK`` turns, so a block's last window may be short.

Template: ``<turn>role newline text</turn>`` for each turn, nothing between.
Inside texts and roles a backslash becomes ``\\s`` and the ``<`` of a marker
``\\l``; a role's line feeds become ``\\n``. Plain replacements undo this, as
no escape ends in a backslash: ``read_back`` gives the turns again.

Scale: DataFrame functions only. Conversations may be of any length: turns are
dealt to ranges of (conversation, turn), numbered and summed inside each range
of a conversation, and the ranges' totals (one row a conversation and range)
carry numbers and prefix sums over. Then the turns meet in blocks; a block
holds at most ``BLOCK`` turns, the few before them and the system turn, so no
task ever holds a whole long conversation. Texts are shuffled three times.

Odd cases: null text or role is empty; turns of equal number are ordered by
role, then by the MD5 of the text, null numbers first; repeated rows are turns
of their own; null ids form one conversation; only the role ``assistant``, as
it is, is a target; an empty target has no span in the mask; a turn longer
than the budget stays whole, in a window of its own behind the system turn,
and the window exceeds the budget (``tokens`` shows it); a system turn that
leaves no room leaves a turn a window. A system turn alone is a window. An
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

OPEN, CLOSE = "<turn>", "</turn>"
SYSTEM, TARGET = "system", "assistant"

BUDGET = 1024
HISTORY_TOKENS = 256
HISTORY_TURNS = 4
BLOCK = 64

#: runs of letters, digits and anything beyond ASCII; other visible characters one by one
TOKEN_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"


def _swap(col: Column, pairs) -> Column:
    for a, b in pairs:
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


def escape(text: Column) -> Column:
    return _swap(text, [("\\", "\\s"), (OPEN, "\\l" + OPEN[1:]), (CLOSE, "\\l" + CLOSE[1:])])


def unescape(text: Column) -> Column:
    return _swap(text, [("\\l", "<"), ("\\s", "\\")])


def escape_role(role: Column) -> Column:
    return _swap(escape(role), [("\n", "\\n")])


def unescape_role(role: Column) -> Column:
    return unescape(_swap(role, [("\\n", "\n")]))


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN_RE)).cast("long")


def numbered_turns(turns: DataFrame, count=count_tokens) -> DataFrame:
    """key, role, text, tokens, idx (from 0), before (tokens of the turns
    before), n (turns of the conversation)."""
    empty = F.lit("")
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), empty).alias("key"),
        "turn",
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    rows = rows.withColumns({"tokens": count(F.col("text")), "tie": F.md5("text"), "row": F.monotonically_increasing_id()})
    order = ["turn", "role", "tie", "row"]
    # written, so that a row's range stays what it is
    rows = stage(rows.repartitionByRange("key", *order).withColumn("range", F.spark_partition_id()), "chat-ranges")
    here = Window.partitionBy("range", "key").orderBy(*order)
    sofar = here.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"at": F.row_number().over(here) - 1, "sum": F.coalesce(F.sum("tokens").over(sofar), F.lit(0))})
    totals = rows.groupBy("range", "key").agg(F.count("*").alias("turns"), F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "range",
        "key",
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.sum("turns").over(Window.partitionBy("key")).alias("n"),
    )
    return rows.join(carried, ["range", "key"]).select(
        "key",
        "role",
        "text",
        "tokens",
        (F.col("turns_before") + F.col("at")).alias("idx"),
        (F.col("tokens_before") + F.col("sum")).alias("before"),
        "n",
    )


def blocks(numbered: DataFrame, block: int = BLOCK, history: int = HISTORY_TURNS) -> DataFrame:
    """A row a block: key, block, turns (its own, those just before it and the
    system turn, in order)."""
    own, last = F.floor(F.col("idx") / block), F.floor((F.col("n") - 1) / block)
    place = lambda b: F.struct(b.cast("long").alias("block"))
    is_system = (F.col("idx") == 0) & (F.col("role") == SYSTEM)
    further = F.sequence(F.lit(1).cast("long"), F.greatest(last, F.lit(1)).cast("long"))
    places = F.concat(
        F.array(place(own)),
        F.when((F.col("idx") % block >= block - history) & (own < last) & ~is_system, F.array(place(own + 1))).otherwise(F.array()),
        F.when(is_system & (last > 0), F.transform(further, place)).otherwise(F.array()),
    )
    rows = numbered.withColumn("place", F.explode(places))
    turn = F.struct("idx", "before", "tokens", "role", "text")
    return rows.groupBy("key", F.col("place.block").alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def windows(
    numbered: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS, block: int = BLOCK
) -> DataFrame:
    """key, first (number of the first new turn), repeated, tokens and turns
    (idx, before, tokens, role, text) of every window."""
    rows = blocks(numbered, block, history_turns)
    head = F.get("turns", F.lit(0))
    rows = rows.withColumn("system", F.when((head["idx"] == 0) & (head["role"] == SYSTEM), head))
    rows = rows.withColumns(
        {
            "system_tokens": F.coalesce(F.col("system.tokens"), F.lit(0)),
            # turns that a span may open with; a system turn opens none, unless it is alone
            "open": F.filter("turns", lambda t: (t["idx"] >= F.col("block") * block) & (F.col("system").isNull() | (t["idx"] > 0))),
        }
    )
    room = F.greatest(F.lit(budget - history_tokens) - F.col("system_tokens"), F.lit(0))

    def step(acc, t):
        new = (F.size(acc["starts"]) == 0) | (t["before"] + t["tokens"] - acc["from"] > room)
        return F.struct(
            F.when(new, t["before"]).otherwise(acc["from"]).alias("from"),
            F.when(new, F.concat(acc["starts"], F.array(t["idx"]))).otherwise(acc["starts"]).alias("starts"),
        )

    none = F.struct(F.lit(0).cast("long").alias("from"), F.array().cast("array<bigint>").alias("starts"))
    starts = F.aggregate("open", none, step, lambda acc: acc["starts"])
    # the first window of all begins with the system turn
    rows = rows.withColumn("starts", F.when(F.size("open") == 0, F.array(F.lit(0).cast("long"))).otherwise(starts))

    def window(start, i):
        stop = F.get(F.col("starts"), i + 1)
        first = F.when((i == 0) & (F.col("block") == 0), F.lit(0).cast("long")).otherwise(start)
        new = F.filter("turns", lambda t: (t["idx"] >= first) & (stop.isNull() | (t["idx"] < stop)))
        spent = F.aggregate(F.filter(new, lambda t: F.col("system").isNull() | (t["idx"] > 0)), F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
        left = F.greatest(F.least(F.lit(history_tokens), F.lit(budget) - F.col("system_tokens") - spent), F.lit(0))
        at = F.get(new, F.lit(0))["before"]
        old = F.filter(
            "turns",
            lambda t: (t["idx"] < first)
            & (((t["idx"] == 0) & F.col("system").isNotNull()) | ((first - t["idx"] <= history_turns) & (at - t["before"] <= left))),
        )
        return F.struct(first.alias("first"), old.alias("old"), new.alias("new"))

    out = rows.select("key", F.explode(F.transform("starts", window)).alias("w"))
    return out.select(
        "key",
        F.col("w.first").alias("first"),
        F.size("w.old").alias("repeated"),
        F.concat("w.old", "w.new").alias("turns"),
    ).withColumn("tokens", F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]))


def format_conversations(turns: DataFrame, count=count_tokens, **options) -> DataFrame:
    """conv_id, first_turn, n_turns, n_repeated (of them), tokens, text and
    loss (code point spans [start, stop) of the targets) of every window."""
    rows = windows(numbered_turns(turns, count), **options)

    def piece(t, i):
        return F.struct(
            F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            ((i >= F.col("repeated")) & (t["role"] == TARGET)).alias("target"),
        )

    rows = rows.withColumn("pieces", F.transform("turns", piece))
    spans = "array<struct<start:bigint,stop:bigint>>"

    def step(acc, p):
        start = acc["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(
            (stop + len(CLOSE)).alias("at"),
            F.when(p["target"] & (stop > start), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("spans"))
    return rows.select(
        F.nullif(F.col("key"), F.lit("")).cast("long").alias("conv_id"),
        F.col("first").alias("first_turn"),
        F.size("turns").alias("n_turns"),
        F.col("repeated").alias("n_repeated"),
        "tokens",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("text"),
        F.aggregate("pieces", none, step, lambda acc: acc["spans"]).alias("loss"),
    )


def read_turns(text: Column) -> Column:
    """The (role, text) of the turns that a window's text holds."""
    parts = F.split(text, CLOSE, -1)
    bodies = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(OPEN) + 1), F.length(p)))

    def parsed(p):
        at = F.instr(p, "\n")
        return F.struct(
            unescape_role(F.substring(p, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(p, at + 1, F.length(p))).alias("text"),
        )

    return F.transform(bodies, parsed)


def loss_text(text: Column, loss: Column) -> Column:
    """What lies under the mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars from the windows' text and mask alone. A digest of a
    conversation takes its whole text in one row."""
    turns = read_turns(F.col("text"))
    new = F.slice(turns, F.col("n_repeated") + 1, F.size(turns))
    part = F.struct(
        "first_turn",
        F.size(new).alias("n"),
        F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        loss_text(F.col("text"), F.col("loss")).alias("loss"),
        F.length("text").alias("chars"),
    )
    by_conv = formatted.select("conv_id", part.alias("part")).groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    loss = F.array_join("parts.loss", "")
    total = lambda c: F.aggregate(F.col(f"parts.{c}"), F.lit(0).cast("long"), lambda a, x: a + x)
    return by_conv.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(F.array_join("parts.turns", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )


ORACLE_SQL = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')
), plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '{TOKEN_RE}')) AS tokens
  FROM given
), t AS (
  SELECT *, row_number() OVER w - 1 AS idx, coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         replace(replace(replace(text, '\\', '\\s'), '<turn>', '\\lturn>'), '</turn>', '\\l/turn>') AS body,
         replace(replace(replace(replace(role, '\\', '\\s'), '<turn>', '\\lturn>'), '</turn>', '\\l/turn>'), chr(10), '\\n') AS head
  FROM plain WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))
), sys AS (
  SELECT conv_id, max(CASE WHEN idx = 0 AND role = 'system' THEN 1 ELSE 0 END) AS has,
         max(CASE WHEN idx = 0 AND role = 'system' THEN tokens ELSE 0 END) AS tok
  FROM t GROUP BY conv_id
), u AS (
  SELECT t.*, sys.has, sys.tok, greatest({BUDGET} - {HISTORY_TOKENS} - sys.tok, 0) AS room
  FROM t JOIN sys ON t.conv_id IS NOT DISTINCT FROM sys.conv_id
), walk AS (
  SELECT conv_id, idx, CAST(0 AS BIGINT) AS start, CAST(tok AS BIGINT) AS base FROM u WHERE idx = 0
  UNION ALL
  SELECT u.conv_id, u.idx,
         CASE WHEN u.idx % {BLOCK} = 0 OR (u.idx > u.has AND u.before + u.tokens - w.base > u.room) THEN u.idx ELSE w.start END,
         CAST(CASE WHEN u.idx % {BLOCK} = 0 OR (u.idx > u.has AND u.before + u.tokens - w.base > u.room) THEN u.before ELSE w.base END AS BIGINT)
  FROM walk w JOIN u ON u.conv_id IS NOT DISTINCT FROM w.conv_id AND u.idx = w.idx + 1
), spans AS (
  SELECT w.conv_id, w.start, min(u.before) AS at, min(u.has) AS has, min(u.tok) AS tok,
         sum(CASE WHEN u.idx < u.has THEN 0 ELSE u.tokens END) AS spent
  FROM walk w JOIN u ON u.conv_id IS NOT DISTINCT FROM w.conv_id AND u.idx = w.idx GROUP BY w.conv_id, w.start
), held AS (
  SELECT w.conv_id, w.idx FROM walk w
  UNION ALL
  SELECT s.conv_id, u.idx FROM spans s JOIN u ON u.conv_id IS NOT DISTINCT FROM s.conv_id AND u.idx < s.start
  WHERE u.idx < s.has
     OR (s.start - u.idx <= {HISTORY_TURNS} AND s.at - u.before <= greatest(least({HISTORY_TOKENS}, {BUDGET} - s.tok - s.spent), 0))
), sizes AS (
  SELECT h.conv_id, CAST(sum(len(u.head) + len(u.body) + {len(OPEN) + 1 + len(CLOSE)}) AS BIGINT) AS formatted_chars
  FROM held h JOIN u ON u.conv_id IS NOT DISTINCT FROM h.conv_id AND u.idx = h.idx GROUP BY h.conv_id
), digest AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY idx) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM t GROUP BY conv_id
)
SELECT d.conv_id, d.n_turns, d.turns_sha256, CAST(len(d.loss) AS BIGINT) AS loss_chars, sha256(d.loss) AS loss_sha256, s.formatted_chars
FROM digest d JOIN sizes s ON d.conv_id IS NOT DISTINCT FROM s.conv_id
"""
