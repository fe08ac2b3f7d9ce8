"""Quotation linking: who answers whom, from what messages quote, with DataFrame functions only.

A message's lines that begin with ``>`` are quotations; more marks are deeper
levels. Texts are split into lines once, and a run of neighbouring lines of one
level is a passage of that level, whatever the depth. A passage,
each of its paragraphs and each of its lines is normalised (lower case, runs of
blanks as one) and hashed. The same hashes of the messages' own texts are joined
to them by (conversation, hash); of several messages with a text the earliest is
the original. A message replies to the latest original that its shallowest linked
quotation names.

Threads follow the replies to their first message by pointer doubling, and
messages are ordered conversation by conversation, thread by thread, then by turn,
so that each comes after what it answers. Positions are counted inside range
partitions and shifted by the partitions' totals.

Work on a conversation or a common text is never gathered in one group: originals
are partial minima, links partial maxima, and the order is a range order.

Defined results: a null text is empty; null conversations or turns link to nothing
and sort first; rows that repeat a conversation and turn are one node with all
their quotations, and each has its own position; a message that quotes only itself
or later turns replies to nothing; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from benefitlens.llm.common import BLANKS, written

#: A quoted line, and the marks it begins with. Only a line feed ends a line, and nothing repeats a group, so that no
#: text is too long or too deep for the pattern.
QUOTED_LINE = r"(?dm)^[ \t]*>[^\n]*(?:\n|\z)"
QUOTES = r"(?dm)^[ \t]*>"
MARKS = r"^[ \t>]*>"
#: A line that announces a quotation, with the quotation.
ANNOUNCED = r"(?dmi)^[ \t]*on\b[^\n]*\bwrote:[ \t\r]*\n(?=[ \t]*>)"
EMPTY_LINES = r"\n[ \t\r]*\n\s*"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), f"[{BLANKS}]+", " "))


def own_text(text: Column) -> Column:
    """The text without quotations and the lines that announce them."""
    bare = F.regexp_replace(F.regexp_replace(text, ANNOUNCED, ""), QUOTED_LINE, "")
    return F.when(F.regexp_like(text, F.lit(QUOTES)), F.btrim(bare, F.lit(" \t\n\x0b\x0c\r"))).otherwise(text)


def _keys(passages: Column) -> Column:
    """Hashes of passages, of their paragraphs and of their lines, without repeats and empty ones."""
    parts = F.concat(passages, F.flatten(F.transform(passages, lambda p: F.split(p, EMPTY_LINES))), F.flatten(F.transform(passages, lambda p: F.split(p, r"\n"))))
    return F.transform(F.array_distinct(F.filter(F.transform(parts, normal), lambda p: p != "")), lambda p: F.sha2(p, 256))


def quoted_lines(messages: DataFrame) -> DataFrame:
    """message, conv_id, turn, no, level (marks), body (without them) of each quoted line; written, so that the numbers of
    messages hold wherever a task runs again."""
    quoting = messages.filter(F.regexp_like("text", F.lit(QUOTES))).withColumn("message", F.monotonically_increasing_id())
    lines = quoting.select("message", "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    lines = lines.withColumn("marks", F.regexp_extract("line", MARKS, 0)).filter("marks != ''")
    body = F.expr("substring(line, length(marks) + 1)")
    level = F.length(F.translate("marks", " \t", ""))
    return written(lines.select("message", "conv_id", "turn", "no", level.alias("level"), F.when(body.startswith(" "), body.substr(F.lit(2), F.length(body))).otherwise(body).alias("body")), "quoted-lines")


def quotations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, hash of each passage, paragraph and line that a message quotes, all levels at once.

    A passage is a run of neighbouring lines of one level: their numbers less their places among the message's lines
    of that level are the same. Lines are grouped by message, level and run, so a group is a part of one text.
    """
    place = F.row_number().over(W.partitionBy("message", "level").orderBy("no"))
    runs = quoted_lines(messages).withColumn("run", F.col("no") - place)
    lines = F.sort_array(F.collect_list(F.struct("no", "body")))["body"]
    passages = runs.groupBy("message", "conv_id", "turn", "level", "run").agg(F.array_join(lines, "\n").alias("passage"))
    return passages.select("conv_id", "turn", "level", F.explode(_keys(F.array("passage"))).alias("hash"))


def replies(messages: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to, n_linked of the messages of which a quotation has an original."""
    quoted = written(quotations(messages).dropDuplicates(["conv_id", "turn", "level", "hash"]), "quotations")
    # only conversations in which something is quoted need an index of their texts
    quoting = quoted.select("conv_id").distinct()
    texts = messages.join(quoting, "conv_id", "left_semi").select("conv_id", "turn", F.explode(_keys(F.array(own_text(F.col("text"))))).alias("hash"))
    originals = texts.groupBy("conv_id", "hash").agg(F.min("turn").alias("original"))
    links = quoted.join(originals, ["conv_id", "hash"]).filter(F.col("original") < F.col("turn"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "original"))
    return links.groupBy("conv_id", "turn").agg(best.alias("best"), F.count("*").alias("n_linked")).select("conv_id", "turn", F.col("best.original").alias("reply_to"), "n_linked")


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, thread (the first message above), depth (replies up to it) of the linked messages."""
    step = written(links.select("conv_id", "turn", F.col("reply_to").alias("up"), F.lit(1).cast("bigint").alias("depth")), "threads")
    while True:
        above = step.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        joined = step.join(above, ["conv_id", "up"], "left")
        step = written(joined.select("conv_id", "turn", F.coalesce("higher", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("higher").isNotNull().alias("moved")), "threads")
        if step.filter("moved").isEmpty():
            return step.select("conv_id", "turn", F.col("up").alias("thread"), "depth")
        step = step.drop("moved")


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, reply_to, thread, depth, position, text (without quotations) of every message."""
    m = messages.select(messages[conv_col].cast("bigint").alias("conv_id"), messages[turn_col].cast("bigint").alias("turn"), messages[role_col].cast("string").alias("role"), F.regexp_replace(F.coalesce(messages[text_col].cast("string"), F.lit("")), "\r\n?", "\n").alias("text"))
    links = written(replies(m), "replies")
    above = links.join(threads(links), ["conv_id", "turn"])
    rows = m.select("conv_id", "turn", "role", own_text(F.col("text")).alias("text")).join(above.select("conv_id", "turn", "reply_to", "thread", "depth"), ["conv_id", "turn"], "left")
    rows = rows.withColumns({"thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0)).cast("bigint")})
    tie = F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("tie")
    by = ["conv_id", "thread", "turn", "tie"]
    ranged = written(rows.withColumn("tie", tie).repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "reply-order")
    totals = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(W.partitionBy("part").orderBy(*by))
    return ranged.withColumn("place", place).join(F.broadcast(before), "part").select("conv_id", "turn", "role", "reply_to", "thread", "depth", (F.col("before") + F.col("place")).alias("position"), "text")


# The same by lines: a passage is a run of neighbouring lines of one level.
ORACLE = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS text,
         row_number() OVER () AS id
  FROM conversations),
lines AS (
  SELECT id, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS no
  FROM m),
levels AS (
  SELECT *, regexp_extract(line, '^((?:[ \t]*> ?)*)', 1) AS marks,
         length(regexp_replace(regexp_extract(line, '^((?:[ \t]*> ?)*)', 1), '[^>]', '', 'g')) AS level
  FROM lines),
kept AS (
  SELECT *, substr(line, length(marks) + 1) AS body FROM (
    SELECT *, level = 0 AND coalesce(lead(level) OVER (PARTITION BY id ORDER BY no), 0) > 0
              AND regexp_matches(line, '(?i)^[ \t]*on\b.*\bwrote:[ \t\r]*$') AS announces,
           max(level) OVER (PARTITION BY id) AS deepest
    FROM levels)),
own AS (
  SELECT m.id, m.conv_id, m.turn, m.role,
         CASE WHEN coalesce(z.deepest, 0) = 0 THEN m.text
              ELSE regexp_replace(coalesce(z.text, ''), '^\s+|\s+$', '', 'g') END AS text
  FROM m LEFT JOIN (SELECT id, max(deepest) AS deepest, string_agg(line, chr(10) ORDER BY no) FILTER (WHERE level = 0 AND NOT announces) AS text
                    FROM kept GROUP BY id) z ON z.id = m.id),
runs AS (
  SELECT *, no - row_number() OVER (PARTITION BY id, level ORDER BY no) AS run FROM kept WHERE level > 0),
passages AS (
  SELECT conv_id, turn, level, string_agg(body, chr(10) ORDER BY no) AS passage FROM runs GROUP BY id, conv_id, turn, level, run),
quoted AS (
  SELECT DISTINCT conv_id, turn, level, key FROM (
    SELECT conv_id, turn, level, trim(regexp_replace(lower(unnest(list_concat([passage], regexp_split_to_array(passage, '\n[ \t\r]*\n\s*'), string_split(passage, chr(10))))), '[\x20\x09-\x0D]+', ' ', 'g')) AS key
    FROM passages) WHERE key <> ''),
originals AS (
  SELECT conv_id, key, min(turn) AS original FROM (
    SELECT conv_id, turn, trim(regexp_replace(lower(unnest(list_concat([text], regexp_split_to_array(text, '\n[ \t\r]*\n\s*'), string_split(text, chr(10))))), '[\x20\x09-\x0D]+', ' ', 'g')) AS key
    FROM own WHERE conv_id IN (SELECT conv_id FROM quoted)) GROUP BY conv_id, key),
linked AS (
  SELECT q.conv_id, q.turn, q.level, o.original FROM quoted q JOIN originals o ON o.conv_id = q.conv_id AND o.key = q.key WHERE o.original < q.turn),
reply AS (
  SELECT conv_id, turn, arg_max(original, -level * 1000000000000 + original) AS reply_to FROM linked GROUP BY conv_id, turn),
up AS (
  SELECT conv_id, turn, reply_to AS above, 1 AS depth FROM reply
  UNION ALL
  SELECT u.conv_id, u.turn, r.reply_to, u.depth + 1 FROM up u JOIN reply r ON r.conv_id = u.conv_id AND r.turn = u.above),
top AS (
  SELECT conv_id, turn, min(above) AS thread, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT o.conv_id, o.turn, o.role, r.reply_to, coalesce(t.thread, o.turn) AS thread, coalesce(t.depth, 0) AS depth,
       row_number() OVER (ORDER BY o.conv_id NULLS FIRST, coalesce(t.thread, o.turn) NULLS FIRST, o.turn NULLS FIRST,
                          sha256(concat_ws(chr(10), o.role, o.text))) AS position, o.text
FROM own o LEFT JOIN reply r ON r.conv_id = o.conv_id AND r.turn = o.turn
LEFT JOIN top t ON t.conv_id = o.conv_id AND t.turn = o.turn
"""
