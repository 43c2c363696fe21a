"""Chat formatting by quotation linking, with DataFrame functions only.

A message's lines are read as own lines or quotes of some level (the number of > marks before
it; spaces between the marks are allowed).  Neighbouring lines of one level are one passage: its
lines are joined to one sequence of lower-case words, so it does not matter where a mail client
broke the lines.  Passages are hashed in windows of WINDOW words, shorter ones as a whole; a line
shorter than a window is hashed as a whole too (in quotes only where the passage has no longer
line).  A quoted passage is joined to the earliest earlier message of the conversation that has
a window (or short line) in its own lines; it comes from the message that holds most of its
windows (ties: the latest).  A message replies to the latest message that its shallowest linked
passages come from.  Following the replies upwards leads to the message that began the thread.

Out of the text go linked passages, and quotes under an attribution line with that line.  Other
lines with marks (code prompts, quotes of something unknown) stay as they are.

The result is one row for every message: its text without quotes and attribution lines, what
it replies to, its thread and depth, and the chat line.  n_quotes counts the different quoted
lines, n_linked those in linked passages.  Ordered by (conv_id, thread_turn,
turn) a conversation reads thread by thread, every reply behind what it answers; messages
without linked quotes begin threads of their own, so a conversation without quotes keeps its
order of turns.  Conversations are never collected: a conversation may hold any share of all
messages.  Originals are pre-aggregated to one row for each (conversation, window), so the
join cannot multiply rows, and only conversations with quotes have their windows made; threads
are found by doubling over the reply links alone.

Cases: null text counts as empty; rows with a null conv_id or turn are not linked and keep
their null; repeated rows of a turn all get the turn's reply; a quote of the message's own or a
later line, or of nothing known, links nothing; texts of any length are read whole (work is
linear in the words); an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, materialize

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: A line that names whom the next quote is from.
ATTRIBUTION = r"(?i)^[ \t]*(?:on\b.{0,200}\bwrote|.{0,100}\b(?:wrote|schrieb|a écrit|escribió))[ \t]*:[ \t]*$"
WINDOW = 5                   # words
MAX_ROUNDS = 64              # doubling rounds; reply chains up to 2^64 messages
BROADCAST = 200_000          # conversations with quotes that are broadcast; more are joined by shuffle


def _lines(text: Column) -> Column:
    """array<struct(level, body, raw)> of a text's lines."""
    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 1)
        body = F.when(marks == "", x).otherwise(F.regexp_replace(x, MARKS, ""))
        return F.struct(F.length(F.translate(marks, " \t", "")).alias("level"), body.alias("body"), x.alias("raw"))
    return F.transform(F.split(text, r"\r?\n"), line)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, row (hash of the text) and the passages of each message in order: level (0: own,
    -1: attribution), cited (under an attribution line), raw lines, words, and the words of each line.
    Each select ends where later expressions look elements up, so that an array is made once."""
    text = F.coalesce(col(messages, "text"), F.lit(""))
    rows = messages.select(
        col(messages, "conv_id").alias("conv_id"), col(messages, "turn").alias("turn"), col(messages, "role").alias("role"),
        F.xxhash64(text).alias("row"), _lines(text).alias("l"))
    attribution = lambda x, k: (x["level"] == 0) & (F.coalesce(F.get("l", k + 1)["level"], F.lit(0)) > 0) & x["body"].rlike(ATTRIBUTION)
    rows = rows.withColumn("v", F.transform("l", lambda x, k: F.when(attribution(x, k), -1).otherwise(x["level"])))
    at = F.sequence(F.lit(0), F.size("v") - 1)
    rows = rows.select(
        "*", F.filter(at, lambda i: F.coalesce((F.get("v", i) > 0) != (F.get("v", i - 1) > 0), F.lit(True))).alias("b"),
        F.filter(at, lambda i: F.coalesce(F.get("v", i) != F.get("v", i - 1), F.lit(True))).alias("s"))
    cited = F.flatten(F.transform("b", lambda i, k: F.array_repeat(
        (F.get("v", i) > 0) & F.coalesce(F.get("v", i - 1) == -1, F.lit(False)), F.coalesce(F.get("b", k + 1), F.size("v")) - i)))
    rows = rows.withColumn("c", cited)

    def passage(i: Column, k: Column) -> Column:
        lines = F.slice("l", i + 1, F.coalesce(F.get("s", k + 1), F.size("v")) - i)
        return F.struct(F.get("v", i).alias("level"), F.get("c", i).alias("cited"), F.transform(lines, lambda x: x["raw"]).alias("raw"),
                        F.transform(lines, lambda x: _words(x["body"])).alias("lines"))
    rows = rows.select("conv_id", "turn", "role", "row", F.transform("s", passage).alias("p"))
    return rows.select("conv_id", "turn", "role", "row", F.transform("p", lambda p: F.struct(
        p["level"].alias("level"), p["cited"].alias("cited"), p["raw"].alias("raw"), p["lines"].alias("lines"),
        F.flatten(p["lines"]).alias("words"))).alias("p"))


def _joined(words: Column) -> Column:
    return F.xxhash64(F.array_join(words, " "))


def _keys(p: Column, short_lines: Column) -> Column:
    """Hashes of a passage's windows (of a shorter passage as a whole) and, where asked, of its short lines."""
    n = F.size(p["words"])
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(p["words"], i + k) for k in range(WINDOW)])))
    some = F.transform(F.filter(p["lines"], lambda w: (F.size(w) > 0) & (F.size(w) < WINDOW)), _joined)
    whole = F.when(n > 0, F.array(_joined(p["words"]))).otherwise(F.array().cast("array<bigint>"))
    return F.array_distinct(F.concat(F.coalesce(windows, whole), F.when(short_lines, some).otherwise(F.array().cast("array<bigint>"))))


def _id(p: Column) -> Column:
    return F.struct(p["level"].alias("level"), _joined(p["words"]).alias("hash"))


def passage_links(rows: DataFrame) -> DataFrame:
    """conv_id, turn, row, id (level, hash), origin of every linked passage."""
    known = rows.where("conv_id is not null and turn is not null")
    quoting = known.where(F.exists("p", lambda p: p["level"] > 0))
    quotes = quoting.select("conv_id", "turn", "row", F.explode(F.filter("p", lambda p: p["level"] > 0)).alias("p")) \
        .select("conv_id", "turn", "row", _id(F.col("p")).alias("id"),
                F.explode(_keys(F.col("p"), ~F.exists(F.col("p.lines"), lambda w: F.size(w) >= WINDOW))).alias("key"))
    some = materialize(rows.sparkSession, quoting.select(F.col("conv_id").alias("_c")).distinct(), "quoting")
    some = F.broadcast(some) if some.count() <= BROADCAST else some
    originals = known.join(some, F.col("conv_id") == F.col("_c"), "left_semi") \
        .select("conv_id", "turn", F.explode(F.filter("p", lambda p: p["level"] == 0)).alias("p")) \
        .select("conv_id", "turn", F.explode(_keys(F.col("p"), F.lit(True))).alias("key")) \
        .groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    each = ["conv_id", "turn", "row", "id"]
    return quotes.join(originals, ["conv_id", "key"]).where("origin < turn") \
        .groupBy(*each, "origin").agg(F.count("*").alias("n")) \
        .groupBy(*each).agg(F.max(F.struct("n", "origin"))["origin"].alias("origin"))


def reply_links(links: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to: a row for every message with a linked passage."""
    best = F.min(F.struct(F.col("id.level").alias("level"), (-F.col("origin")).alias("late")))
    return links.groupBy("conv_id", "turn").agg((-best["late"]).alias("reply_to"))


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, thread_turn, depth of every message with a link, by pointer doubling."""
    spark = links.sparkSession
    now = materialize(spark, links.select("conv_id", "turn", F.col("reply_to").alias("thread_turn"), F.lit(1).cast("long").alias("depth")), "threads")
    for _ in range(MAX_ROUNDS):
        up = now.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("thread_turn").alias("_up"), F.col("depth").alias("_d"))
        step = now.join(up, (F.col("conv_id") == F.col("_c")) & (F.col("thread_turn") == F.col("_t")), "left")
        if step.where("_up is not null").isEmpty():
            return now
        now = materialize(spark, step.select("conv_id", "turn", F.coalesce("_up", "thread_turn").alias("thread_turn"),
                                             (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth")), "threads")
    return now


def query(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (own lines), n_quotes, n_linked, reply_to, thread_turn, depth, chat of every message."""
    spark = messages.sparkSession
    rows = materialize(spark, parsed(messages), "messages")      # a filter on passages must not parse texts over again
    links = materialize(spark, passage_links(rows), "passage-links")
    replies = materialize(spark, reply_links(links), "reply-links")
    found = replies.join(threads(replies), ["conv_id", "turn"])
    passages = links.groupBy("conv_id", "turn", "row").agg(F.collect_set("id").alias("linked"))      # of one message
    is_linked = lambda p: F.coalesce(F.array_contains("linked", _id(p)), F.lit(False))
    own = F.filter("p", lambda p: (p["level"] == 0) | (p["level"] > 0) & ~p["cited"] & ~is_linked(p))
    quoted = F.filter("p", lambda p: p["level"] > 0)

    def lines(of: Column, leveled: bool) -> Column:
        return F.array_distinct(F.flatten(F.transform(of, lambda p: F.transform(F.filter(p["lines"], lambda w: F.size(w) > 0), lambda w: F.struct(
            (p["level"] if leveled else F.lit(0)).alias("level"), F.array_join(w, " ").alias("line"))))))
    out = rows.join(passages, ["conv_id", "turn", "row"], "left").select(
        "conv_id", "turn", "role", F.trim(F.array_join(F.flatten(F.transform(own, lambda p: p["raw"])), "\n"), F.lit(" \t\r\n")).alias("text"),
        F.size(lines(quoted, True)).cast("long").alias("n_quotes"),
        F.size(lines(F.filter("p", lambda p: (p["level"] > 0) & is_linked(p)), False)).cast("long").alias("n_linked"))
    chat = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    return out.join(found, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", "n_quotes", "n_linked",
        "reply_to", F.coalesce("thread_turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), chat.alias("chat"))


def conversations(messages: DataFrame) -> DataFrame:
    """``query`` in reading order: sorted by conversation, thread and turn."""
    return query(messages).orderBy("conv_id", "thread_turn", "turn")


ORACLE_SQL = rf"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS l
  FROM conversations
), line AS (
  SELECT id, conv_id, turn, role, unnest(l) AS x, unnest(range(len(l))) AS k FROM m
), p AS (
  SELECT *, regexp_extract(x, '^[ \t]*((?:>[ \t]?)+)', 1) AS marks FROM line
), q AS (
  SELECT *, length(regexp_replace(marks, '[ \t]', '', 'g')) AS depth_read,
         CASE WHEN marks = '' THEN x ELSE regexp_replace(x, '^[ \t]*((?:>[ \t]?)+)', '') END AS body
  FROM p
), v AS (
  SELECT *, list_filter(regexp_split_to_array(lower(body), '[\x20\x09-\x0D]+'), lambda y: y <> '') AS words,
         CASE WHEN depth_read = 0 AND coalesce(lead(depth_read) OVER d, 0) > 0
           AND regexp_matches(body, '(?i)^[ \t]*(?:on\b.{{0,200}}\bwrote|.{{0,100}}\b(?:wrote|schrieb|a écrit|escribió))[ \t]*:[ \t]*$')
           THEN -1 ELSE depth_read END AS level
  FROM q WINDOW d AS (PARTITION BY id ORDER BY k)
), edge AS (
  SELECT *, lag(level) OVER d AS last FROM v WINDOW d AS (PARTITION BY id ORDER BY k)
), run AS (
  SELECT *, sum(CASE WHEN last = level THEN 0 ELSE 1 END) OVER d AS passage,
         sum(CASE WHEN (last > 0) = (level > 0) THEN 0 ELSE 1 END) OVER d AS block
  FROM edge WINDOW d AS (PARTITION BY id ORDER BY k)
), w AS (
  SELECT *, level > 0 AND bool_or(coalesce(last, 0) = -1) OVER (PARTITION BY id, block) AS cited FROM run
), pas AS (
  SELECT id, conv_id, turn, passage, any_value(level) AS level, flatten(list(words ORDER BY k)) AS ws, max(len(words)) AS longest
  FROM w WHERE level >= 0 GROUP BY ALL
), long_key AS (
  SELECT id, conv_id, turn, passage, level, unnest(list_transform(range(0, len(ws) - {WINDOW - 1}), lambda i: array_to_string(ws[i + 1:i + {WINDOW}], ' '))) AS key
  FROM pas WHERE len(ws) >= {WINDOW}
), whole AS (
  SELECT id, conv_id, turn, passage, level, array_to_string(ws, ' ') AS key FROM pas WHERE len(ws) BETWEEN 1 AND {WINDOW - 1}
), short_line AS (
  SELECT w.id, w.conv_id, w.turn, w.passage, w.level, array_to_string(words, ' ') AS key
  FROM w JOIN pas USING (id, passage) WHERE len(words) BETWEEN 1 AND {WINDOW - 1} AND (w.level = 0 OR longest < {WINDOW})
), keys AS (
  SELECT * FROM long_key UNION SELECT * FROM whole UNION SELECT * FROM short_line
), origins AS (
  SELECT conv_id, key, min(turn) AS origin FROM keys WHERE level = 0 GROUP BY ALL
), votes AS (
  SELECT id, conv_id, turn, passage, level, origin, count(*) AS n
  FROM keys JOIN origins USING (conv_id, key) WHERE level > 0 AND origin < turn GROUP BY ALL
), linked AS (
  SELECT id, conv_id, turn, passage, level, arg_max(origin, (n, origin)) AS origin FROM votes GROUP BY ALL
), top AS (
  SELECT conv_id, turn, min(level) AS level FROM linked GROUP BY ALL
), reply AS (
  SELECT conv_id, turn, max(origin) AS reply_to FROM linked JOIN top USING (conv_id, turn, level) GROUP BY ALL
), up AS (
  SELECT conv_id, turn, reply_to AS origin, 1 AS depth FROM reply
  UNION ALL
  SELECT up.conv_id, up.turn, reply.reply_to, depth + 1 FROM up JOIN reply ON reply.conv_id = up.conv_id AND reply.turn = up.origin
), root AS (
  SELECT conv_id, turn, arg_max(origin, depth) AS thread_turn, max(depth) AS depth FROM up GROUP BY ALL
), base AS (
  SELECT w.id, w.conv_id, w.turn, role,
         trim(string_agg(CASE WHEN w.level = 0 OR w.level > 0 AND NOT cited AND linked.id IS NULL THEN x END, chr(10) ORDER BY k),
              ' ' || chr(9) || chr(13) || chr(10)) AS text,
         count(DISTINCT CASE WHEN w.level > 0 AND len(words) > 0 THEN (w.level, words) END) AS n_quotes,
         count(DISTINCT CASE WHEN linked.id IS NOT NULL AND len(words) > 0 THEN words END) AS n_linked
  FROM w LEFT JOIN linked USING (id, passage) GROUP BY ALL
)
SELECT conv_id, turn, role, coalesce(text, '') AS text, n_quotes, n_linked,
       reply_to, coalesce(thread_turn, turn) AS thread_turn,
       CAST(coalesce(depth, 0) AS BIGINT) AS depth,
       '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS chat
FROM base LEFT JOIN reply USING (conv_id, turn) LEFT JOIN root USING (conv_id, turn)
"""
