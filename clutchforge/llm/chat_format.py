"""Chat formatting with budgeted windows (DataFrame expressions only).

A turn is written ``<turn ROLE>\\n`` + text + ``\\n</turn>\\n``; inside roles and texts a
backslash becomes ``\\b`` and ``<`` becomes ``\\l``, so no control string of the template can
occur in them, and reading back undoes it exactly.

Prefix sums of the turns' tokens (words of the text plus ``TURN_TOKENS`` for the
template) cut a conversation into turn-aligned windows. Each window after the first repeats the
conversation's opening system turn; so ``budget - history`` less that turn is left for its own turns,
and a window takes turns as long as their prefix sums stay within it. It also repeats the turns that end the
previous window, as far as they fit into ``history`` tokens and the budget. So no window passes the
budget, except that of a single turn that doesn't fit beside the system turn: it is kept whole and marked ``over_budget``.

Windows are chosen by a fold over the prefix sums (numbers only) of a cell, the turns that start within
``CELL_BUDGETS`` budgets of tokens, so that a conversation with very many turns is cut in many
tasks; a window ends with its cell.

The loss mask of a window lists the text spans (from, characters) of its own assistant
turns; repeated turns are never in it, so each assistant text is a target once.

Prefix sums are taken in two steps, inside blocks of ``BLOCK`` turn numbers and over the
blocks, so a conversation with very many rows is not sorted in one task.

Defined results: null roles and texts count as empty; rows are ordered by turn
(null first), role, text; identical rows are separate turns; a null conv_id is a
conversation of its own; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITESPACE, materialise, prepare, split_words, table

BUDGET = 1024
HISTORY = 256
TURN_TOKENS = 4
BLOCK = 64
CELL_BUDGETS = 64
OPEN, ROLE_END, CLOSE = "<turn ", ">\n", "\n</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    # Every backslash of an escaped text starts an escape, so the order of undoing is free of doubt.
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    """Roles lie before ``>`` and a line end, so those are escaped as well."""
    return F.replace(F.replace(escape(c), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(F.replace(c, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n")))


def _turns(conversations: DataFrame) -> DataFrame:
    """Rows with their place: copy number among identical rows, tokens, tokens before."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("tokens", F.size(split_words(F.col("text"), WHITESPACE)).cast("long") + TURN_TOKENS) \
        .withColumn("block", F.floor(F.col("turn") / BLOCK))
    rows = materialise(rows, "turns")
    sums = rows.groupBy("conv_id", "block").agg(F.sum(F.col("tokens") * F.col("copies")).alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum(F.col("tokens") * F.col("copies")).over(inside), F.lit(0)))
    placed = rows.alias("r").join(sums.alias("s"), F.expr("r.conv_id <=> s.conv_id and r.block <=> s.block")) \
        .select("r.*", (F.col("s.base") + F.col("r.inner")).alias("base"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    return placed.select("*", copy).select(
        "conv_id", "role", "text", "tokens", (F.col("base") + F.col("copy") * F.col("tokens")).alias("before"))


def _written(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), escape_role(t["role"]), F.lit(ROLE_END), escape(t["text"]), F.lit(CLOSE)))


def _placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """``turns`` with the tokens of their conversation's opening system turn (``lead``) and the ``window`` they
    belong to, which is named by the tokens before its first turn."""
    opens = (F.col("before") == 0) & (F.col("role") == "system")
    leads = turns.filter(opens).select(F.col("conv_id").alias("c"), F.col("tokens").alias("lead"))
    turns = turns.alias("t").join(leads.alias("l"), F.expr("t.conv_id <=> l.c"), "left") \
        .select("t.*", F.coalesce("l.lead", F.lit(0).cast("long")).alias("lead")) \
        .withColumn("cell", F.floor(F.col("before") / (CELL_BUDGETS * budget)))
    room = F.greatest(F.lit(budget - history) - F.max("lead"), F.lit(0)).alias("room")
    cells = turns.groupBy("conv_id", "cell").agg(
        F.array_sort(F.collect_list(F.struct("before", "tokens"))).alias("sums"), room, F.max("lead").alias("lead"))

    def step(acc: Column, t: Column) -> Column:
        fits = acc["starts"].isNotNull() & (t["before"] + t["tokens"] - acc["from"] <= F.col("room"))
        # The opening system turn takes no room: it has its own.
        start = F.when(t["before"] == 0, F.col("lead")).otherwise(t["before"])
        begun = F.concat(F.coalesce(acc["starts"], F.array().cast("array<bigint>")), F.array(t["before"]))
        return F.struct(F.when(fits, acc["from"]).otherwise(start).alias("from"), F.when(fits, acc["starts"]).otherwise(begun).alias("starts"))

    none = F.struct(F.lit(0).cast("long").alias("from"), F.lit(None).cast("array<bigint>").alias("starts"))
    starts = cells.select("conv_id", "cell", F.aggregate("sums", none, step, lambda acc: acc["starts"]).alias("starts"))
    return turns.alias("t").join(starts.alias("s"), F.expr("t.conv_id <=> s.conv_id and t.cell = s.cell")) \
        .select("t.*", F.array_max(F.filter("s.starts", lambda x: x <= F.col("t.before"))).alias("window")).drop("cell")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, text, loss (array of from, chars), tokens, repeated
    (turns at its start that are not its own), over_budget."""
    turns = materialise(_placed(_turns(conversations), budget, history), "placed")
    item = F.struct("before", "role", "text", "tokens")
    own = materialise(turns.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(item)).alias("own"), F.sum("tokens").alias("size"), F.max("lead").alias("lead")), "own")
    # The window that follows each window, and how far back it reaches.
    after = Window.partitionBy("conv_id").orderBy("window")
    left = F.least(F.lit(history), F.lit(budget) - F.col("lead") - F.lead("size").over(after))
    next_ = own.select("conv_id", "window", F.lead("window").over(after).alias("next"), left.alias("left")).filter("next is not null")
    tails = own.alias("o").join(next_.alias("n"), F.expr("o.conv_id <=> n.conv_id and o.window = n.window")).select(
        "o.conv_id", F.col("n.next").alias("window"),
        F.filter("o.own", lambda t: (t["before"] >= F.col("n.next") - F.col("n.left"))
                 & ~((t["before"] == 0) & (t["role"] == "system"))).alias("tail"))
    system = turns.filter((F.col("before") == 0) & (F.col("role") == "system")) \
        .select("conv_id", F.array(item).alias("system"))
    none = F.array().cast("array<struct<before:bigint,role:string,text:string,tokens:bigint>>")
    all_ = own.alias("o").join(tails.alias("t"), F.expr("o.conv_id <=> t.conv_id and o.window = t.window"), "left") \
        .join(system.alias("s"), F.expr("o.conv_id <=> s.conv_id and o.window > 0"), "left") \
        .select("o.conv_id", "o.window", "o.own",
                F.concat(F.coalesce("s.system", none), F.coalesce("t.tail", none)).alias("again"))
    out = all_.select(
        "conv_id", "window", "own", F.size("again").alias("repeated"),
        _written(F.col("again")).alias("head"), _written(F.col("own")).alias("body"),
        F.aggregate(F.concat("again", "own"), F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("tokens"))
    lead = F.coalesce(F.length(F.array_join("head", "")), F.lit(0))
    spans = F.aggregate(
        F.sequence(F.lit(0), F.size("own") - 1),
        F.struct(lead.alias("at"), F.array().cast("array<struct<from:int,chars:int>>").alias("spans")),
        lambda a, i: F.struct(
            (a["at"] + F.length(F.get("body", i))).alias("at"),
            F.when(F.get("own", i)["role"] == "assistant", F.concat(a["spans"], F.array(F.struct(
                (a["at"] + len(OPEN + "assistant" + ROLE_END)).alias("from"),
                F.length(escape(F.get("own", i)["text"])).alias("chars"))))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    return out.select("conv_id", "window", F.array_join(F.concat("head", "body"), "").alias("text"),
                      spans.alias("loss"), "tokens", "repeated", (F.col("tokens") > budget).alias("over_budget"))


def read_windows(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the windows' texts and masks alone: ``turns`` (role, text
    of every turn once, in order) and ``targets`` (the unescaped texts under the mask, in order)."""
    parts = F.slice(F.split("text", F.lit(OPEN)), F.lit(2) + F.col("repeated"), F.size(F.split("text", F.lit(OPEN))))
    turn = F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(p, ROLE_END, 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, F.lit(ROLE_END)) + len(ROLE_END),
                             F.length(p) - F.instr(p, F.lit(ROLE_END)) + 1 - len(ROLE_END) - len(CLOSE))).alias("text")))
    target = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["from"] + 1, s["chars"])))
    each = windows.select("conv_id", "window", turn.alias("turns"), target.alias("targets"),
                          F.length("text").cast("long").alias("chars"))
    got = each.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
        F.sum("chars").alias("formatted_chars"))
    return got.select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
                      F.flatten(F.transform("w", lambda x: x["targets"])).alias("targets"), "formatted_chars")


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    conversations = table(prepare(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(says).alias("text"))
    windows = materialise(format_windows(conversations.unionByName(extra)), "windows")
    read = read_windows(windows)
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("targets", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       "formatted_chars")


def oracle() -> str:
    mark, cell = len(OPEN) + len(ROLE_END) + len(CLOSE), CELL_BUDGETS * BUDGET
    return rf"""
with recursive c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
t as (select row_number() over () as rid, *,
  len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) + {TURN_TOKENS} as tokens,
  {mark} + length(role) + length(text) + length(regexp_replace(text || role, '[^\\<]', '', 'g'))
    + length(regexp_replace(role, '[^>\n]', '', 'g')) as chars from c),
o as (select *, coalesce(sum(tokens) over (partition by conv_id order by turn nulls first, role, text, rid
  rows between unbounded preceding and 1 preceding), 0) as before from t),
lead as (select conv_id, tokens as lead, chars from o where before = 0 and role = 'system'),
room as (select distinct o.conv_id, coalesce(lead, 0) as lead, greatest({BUDGET - HISTORY} - coalesce(lead, 0), 0) as room
  from o left join lead on lead.conv_id is not distinct from o.conv_id),
starts as (
  select conv_id, 0::hugeint as win, lead as base, lead, room from room
  union all
  select conv_id, nxt, nxt, lead, room
  from (select s.conv_id, s.lead, s.room, (select min(o.before) from o where o.conv_id is not distinct from s.conv_id and o.before > s.win
          and (o.before + o.tokens - s.base > s.room or o.before // {cell} <> s.win // {cell})) as nxt
        from starts s) where nxt is not null),
w as (select o.*, s.win from o asof join starts s on o.conv_id is not distinct from s.conv_id and o.before >= s.win),
sizes as (select conv_id, win, sum(tokens) as size, lag(win) over (partition by conv_id order by win) as prev from w group by conv_id, win),
history as (select s.conv_id, sum(w.chars) as chars
  from sizes s join room r on r.conv_id is not distinct from s.conv_id
  join w on w.conv_id is not distinct from s.conv_id and w.win = s.prev and not (w.before = 0 and w.role = 'system')
    and w.before >= s.win - least({HISTORY}, {BUDGET} - r.lead - s.size) group by s.conv_id),
system as (select l.conv_id, sum(l.chars) as chars from lead l join sizes s on s.conv_id is not distinct from l.conv_id and s.win > 0
  group by l.conv_id),
a as (select conv_id, count(*) as n_turns, sum(chars) as chars,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by before, rid)) as turns_sha256,
  coalesce(string_agg(text, '' order by before, rid) filter (where role = 'assistant'), '') as loss from w group by conv_id)
select a.conv_id, n_turns, turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
  (a.chars + coalesce(h.chars, 0) + coalesce(s.chars, 0))::bigint as formatted_chars
from a left join history h on h.conv_id is not distinct from a.conv_id
  left join system s on s.conv_id is not distinct from a.conv_id"""
