"""Chat formatting by quotation linking, with DataFrame functions only.

Lines that begin with ``>`` marks are quoted; the number of marks is the level.
A message's maximal runs of lines of one level are its passages.  A line
"On ... wrote:" right before a deeper line introduces a quotation and is
dropped.  Passages of level 0 are the message's own text.

Own texts, own passages and their paragraphs are hashed after normalisation
(A-Z lower-cased, white space collapsed); so are quoted passages and their
paragraphs.  A quoted unit's original is the first message of the same
conversation with that unit, if it is earlier, else the first such message of
any conversation if that is another one.  A message replies to the original of
its best linked unit: of its own conversation before others, then the lowest
level, the longest unit, the latest original.  A message without a linked
quotation replies to the turn before it.

Messages are parsed and hashed once and written.  Originals are pre-aggregated
per hash (and conversation) before any join, so a passage that many messages
share is one row.  Turns before a message, and its rank in the reply order, are
found in steps, inside blocks of turns and over one row per block, so a very
long conversation isn't one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.runtime import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = r"[\x20\x09-\x0D]+"
MARK = r"^[ \t]*>[> \t]*"
INTRODUCTION = r"^On .{1,200} wrote:[ \t]*$"
PARAGRAPH = r"\n[ \t]*\n"
#: Turns per block of the two-step windows.
TURNS = 64
#: Stands for the parent of messages without one in their conversation, before all turns.
_FIRST = -(1 << 62)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), WHITE, " "))


def _units(passages: Column) -> Column:
    """Distinct (hash, size) of passages (an array of texts) and their paragraphs."""
    parts = F.concat(passages, F.flatten(F.transform(passages, lambda p: F.split(p, PARAGRAPH, -1))))
    texts = F.array_distinct(F.filter(F.transform(parts, normalised), lambda t: t != ""))
    return F.transform(texts, lambda t: F.struct(F.md5(t).alias("hash"), F.length(t).cast("long").alias("size")))


def parse_quotes(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds own (text without quotations) and passages, an array of (level, body) in order; -1: dropped introductions."""
    clean = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "\r", "")
    marks = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, MARK, 0), "[^>]", ""))
    lines = F.transform(
        F.split("_clean", "\n", -1),
        lambda x: F.struct(marks(x).alias("level"), F.regexp_replace(x, MARK, "").alias("body")),
    )
    after = lambda i: F.get("_lines", i + 1)["level"]
    dropped = F.transform(
        "_lines", lambda x, i: F.struct(
            F.when(
                x["body"].rlike(INTRODUCTION) & (F.coalesce(after(i), F.lit(0)) > x["level"]), F.lit(-1)
            ).otherwise(x["level"]).alias("level"),
            x["body"].alias("body"),
        )
    )
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1),
        lambda i: (i == 0) | (F.get("_lines", i)["level"] != F.get("_lines", i - 1)["level"]),
    )
    body = lambda s, k: F.array_join(
        F.transform(
            F.slice("_lines", s + 1, F.coalesce(F.get("_starts", k + 1), F.size("_lines")) - s), lambda x: x["body"]
        ),
        "\n",
    )
    runs = F.transform(
        "_starts", lambda s, k: F.struct(F.get("_lines", s)["level"].alias("level"), body(s, k).alias("body"))
    )
    quoting = F.col("_clean").rlike(r"(?m)^[ \t]*>")
    parsed = (
        messages.withColumn("_clean", clean)
        .withColumn("_lines", F.when(quoting, lines))
        .withColumn("_lines", F.when(F.col("_lines").isNotNull(), dropped))
        .withColumn("_starts", F.when(F.col("_lines").isNotNull(), starts))
        .withColumn(
            "passages",
            F.coalesce(
                F.when(F.col("_lines").isNotNull(), runs),
                F.array(F.struct(F.lit(0).alias("level"), F.col("_clean").alias("body"))),
            ),
        )
    )
    own = F.array_join(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["body"]), "\n")
    return parsed.withColumn(
        "own", F.regexp_replace(own, rf"^{WHITE}|{WHITE}$", "")
    ).drop("_clean", "_lines", "_starts")


def _before(rows: DataFrame, keys: list[str], value: str, n: str) -> DataFrame:
    """keys, ``value`` and how many (the sum of ``n``) rows of the same keys have a smaller value, from one row per value:
    inside blocks of TURNS values, and over one row a block."""
    rows = rows.withColumn("_block", F.floor(F.col(value) / TURNS))
    inside = F.sum(n).over(
        Window.partitionBy(*keys, "_block").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = rows.groupBy(*keys, "_block").agg(F.sum(n).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(*keys, "_block", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    joined = rows.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(blocks, [*keys, "_block"])
    return joined.select(*keys, value, (F.col("_inside") + F.col("_ahead")).alias("before"))


def link_quotations(conversations: DataFrame) -> DataFrame:
    """Every message of ``conversations`` (conv_id, turn, role, text) without quotations, with what it replies to.

    Returns conv_id, turn, role, text (own), formatted ("<|role|>", a line end,
    the own text), n_quotes (quoted passages with any text), n_linked (of these,
    with an original), parent_conv_id, parent_turn (-1: none), linked (the parent is an
    original of a quotation), position (messages of earlier turns in the
    conversation) and reply_rank: how many messages of the conversation come
    before it in reply order, which is by the turn of the parent (those without
    a parent in the conversation first), then by turn.  ``assembled`` puts the
    conversations together.

    A null text is empty, a null role is "".  A message with a null conv_id or
    turn has no position, rank or parent and is nobody's original.  Rows with
    equal conv_id and turn are kept and share what precedes them; other columns
    are left out; an empty table gives an empty result.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("source"),
    )
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    own = F.filter("passages", lambda p: p["level"] == 0)
    quoted = F.filter("passages", lambda p: (p["level"] > 0) & (normalised(p["body"]) != ""))
    parsed = parse_quotes(rows, "source").select(
        "conv_id", "turn", "role", "own", F.md5("source").alias("key"), _units(
            F.concat(F.array("own"), F.transform(own, lambda p: p["body"]))
        ).alias("own_units"),
        F.transform(
            quoted, lambda p: F.struct(p["level"].alias("level"), _units(F.array(p["body"])).alias("units"))
        ).alias("quoted"),
    )
    parsed = materialise(parsed, "messages")

    units = parsed.filter(placed).select("conv_id", "turn", F.explode("own_units").alias("unit"))
    asked = (
        parsed.filter(placed & (F.size("quoted") > 0))
        .select("conv_id", "turn", "key", F.posexplode("quoted").alias("passage", "p"))
        .select(
            "conv_id", "turn", "key", "passage", F.col("p.level").alias("level"), F.explode("p.units").alias("unit")
        )
        .select("conv_id", "turn", "key", "passage", "level", "unit.hash", "unit.size")
        .distinct()
    )
    in_conversation = units.groupBy("unit.hash", "conv_id").agg(F.min("turn").alias("o_turn")).join(
        asked.select("hash").distinct(), "hash", "left_semi"
    )
    anywhere = in_conversation.groupBy("hash").agg(F.min(F.struct("conv_id", "o_turn")).alias("first"))
    found = asked.join(in_conversation, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    local = F.col("o_turn") < F.col("turn")
    other = F.col("first.conv_id") != F.col("conv_id")
    found = found.select(
        "conv_id", "turn", "key", "passage", "level", "size",
        F.when(local, F.col("conv_id")).when(other, F.col("first.conv_id")).alias("p_conv"),
        F.when(local, F.col("o_turn")).when(other, F.col("first.o_turn")).alias("p_turn"),
    ).filter("p_conv is not null")
    best = found.groupBy("conv_id", "turn", "key").agg(
        F.max(
            F.struct(
                (F.col("p_conv") == F.col("conv_id")).alias("near"), F.negate("level").alias("depth"), "size", "p_turn",
                F.negate("p_conv").alias("back"),
            )
        ).alias("best"),
        F.countDistinct("passage").alias("n_linked"),
    )

    # turns before a message: inside its block of turns, else the last of the block before
    blocked = parsed.select(
        "conv_id", "turn", "role", "own", "key", F.size("quoted").cast("long").alias("n_quotes"),
        F.floor(F.col("turn") / TURNS).alias("block"),
    )
    blocks = blocked.filter(placed).groupBy("conv_id", "block").agg(
        F.max("turn").alias("last"), F.count("*").alias("n")
    )
    by_block = Window.partitionBy("conv_id").orderBy("block")
    blocks = blocks.select(
        "conv_id", "block", F.lag("last").over(by_block).alias("b_turn"),
        F.coalesce(F.sum("n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b_rows"),
    )
    earlier = Window.partitionBy("conv_id", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    within = blocked.withColumn("w_turn", F.max("turn").over(earlier)).withColumn(
        "w_rows", F.count("turn").over(earlier)
    )
    joined = within.join(blocks, ["conv_id", "block"], "left").join(best, ["conv_id", "turn", "key"], "left")
    linked = F.col("best").isNotNull()
    before = F.coalesce("w_turn", "b_turn")
    told = joined.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce(
            F.when(linked, F.negate("best.back")).when(placed & before.isNotNull(), F.col("conv_id")), F.lit(-1)
        ).alias("parent_conv_id"),
        F.coalesce(F.when(linked, F.col("best.p_turn")).when(placed, before), F.lit(-1)).alias("parent_turn"),
        linked.alias("linked"), F.when(placed, F.col("w_rows") + F.col("b_rows")).alias("position"),
    )
    # reply order: messages with a smaller parent, and messages of the same parent with a smaller turn
    told = materialise(
        told.withColumn(
            "_parent",
            F.coalesce(F.when(F.col("parent_conv_id") == F.col("conv_id"), F.col("parent_turn")), F.lit(_FIRST)),
        ),
        "replies",
    )
    counted = told.filter(placed).groupBy("conv_id", "_parent", "turn").agg(F.count("*").alias("n"))
    siblings = _before(counted, ["conv_id", "_parent"], "turn", "n").withColumnRenamed("before", "_siblings")
    families = _before(
        counted.groupBy("conv_id", "_parent").agg(F.sum("n").alias("n")), ["conv_id"], "_parent", "n"
    ).withColumnRenamed("before", "_families")
    ranks = siblings.join(families, ["conv_id", "_parent"]).select(
        "conv_id", "_parent", "turn", (F.col("_siblings") + F.col("_families")).alias("reply_rank")
    )
    ranked = told.join(ranks, ["conv_id", "_parent", "turn"], "left")
    formatted = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text")
    return ranked.withColumn("formatted", formatted).drop("_parent")


def assembled(linked: DataFrame, messages: int = TURNS) -> DataFrame:
    """Conversations in reply order, from ``link_quotations``: (conv_id, part, messages), where messages is an array of (reply_rank,
    turn, role, text), at most about ``messages`` a part, since a conversation may have any length.  Messages without a place stay out."""
    rows = linked.filter("reply_rank is not null").withColumn("part", F.floor(F.col("reply_rank") / messages))
    return rows.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("reply_rank", "turn", "role", "text"))).alias("messages")
    )


#: The same rows in DuckDB SQL over a table ``conversations``.
SQL = rf"""
WITH msgs AS (
  SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS source,
         replace(coalesce(text, ''), chr(13), '') AS clean
  FROM conversations
), lines AS (
  SELECT id, pos, len(regexp_replace(regexp_extract(line, '^[ \t]*>[> \t]*'), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t]*>[> \t]*', '') AS body
  FROM (SELECT id, unnest(string_split(clean, chr(10))) AS line, generate_subscripts(string_split(clean, chr(10)), 1) AS pos FROM msgs)
), marked AS (
  SELECT id, pos, body, CASE WHEN regexp_matches(body, '^On .{{1,200}} wrote:[ \t]*$')
    AND coalesce(lead(level) OVER (PARTITION BY id ORDER BY pos), 0) > level THEN -1 ELSE level END AS level
  FROM lines
), stepped AS (
  SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY id ORDER BY pos) THEN 1 ELSE 0 END AS step FROM marked
), numbered AS (
  SELECT *, sum(step) OVER (PARTITION BY id ORDER BY pos) AS run FROM stepped
), passages AS (
  SELECT id, run, any_value(level) AS level, string_agg(body, chr(10) ORDER BY pos) AS body FROM numbered GROUP BY id, run
), owns AS (
  SELECT id, regexp_replace(string_agg(body, chr(10) ORDER BY run), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS own
  FROM passages WHERE level = 0 GROUP BY id
), pieces AS (
  SELECT id, 0 AS run, 0 AS level, own AS body FROM owns UNION ALL SELECT id, run, level, body FROM passages WHERE level >= 0
), texts AS (
  SELECT id, run, level, body AS t FROM pieces UNION ALL SELECT id, run, level, unnest(regexp_split_to_array(body, '\n[ \t]*\n')) FROM pieces
), units AS (
  SELECT DISTINCT id, run, level, t FROM (
    SELECT id, run, level, trim(regexp_replace(translate(t, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g')) AS t FROM texts) WHERE t <> ''
), placed AS (
  SELECT * FROM msgs WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), in_conversation AS (
  SELECT t, conv_id, min(turn) AS o_turn FROM units JOIN placed USING (id) WHERE level = 0 GROUP BY t, conv_id
), anywhere AS (
  SELECT t, min(conv_id) AS f_conv, arg_min(o_turn, conv_id) AS f_turn FROM in_conversation GROUP BY t
), found AS (
  SELECT u.id, u.run, u.level, length(u.t) AS size, m.conv_id,
    CASE WHEN i.o_turn < m.turn THEN m.conv_id WHEN a.f_conv <> m.conv_id THEN a.f_conv END AS p_conv,
    CASE WHEN i.o_turn < m.turn THEN i.o_turn WHEN a.f_conv <> m.conv_id THEN a.f_turn END AS p_turn
  FROM units u JOIN placed m USING (id) LEFT JOIN in_conversation i ON i.t = u.t AND i.conv_id = m.conv_id LEFT JOIN anywhere a ON a.t = u.t
  WHERE u.level > 0
), best AS (
  SELECT id, count(DISTINCT run) AS n_linked,
    max(ROW(p_conv = conv_id, -level, size, p_turn, -p_conv)) AS b
  FROM found WHERE p_conv IS NOT NULL GROUP BY id
), quotes AS (
  SELECT id, count(DISTINCT run) AS n_quotes FROM units WHERE level > 0 GROUP BY id
), before AS (
  SELECT id, max(turn) OVER w AS b_turn, count(*) OVER w AS position FROM placed
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), told AS (
SELECT m.conv_id, m.turn, m.role, coalesce(o.own, '') AS text, '<|' || m.role || '|>' || chr(10) || coalesce(o.own, '') AS formatted,
  coalesce(q.n_quotes, 0) AS n_quotes, coalesce(b.n_linked, 0) AS n_linked,
  coalesce(CASE WHEN b.id IS NOT NULL THEN -b.b[5] WHEN e.b_turn IS NOT NULL THEN m.conv_id END, -1) AS parent_conv_id,
  coalesce(CASE WHEN b.id IS NOT NULL THEN b.b[4] ELSE e.b_turn END, -1) AS parent_turn,
  b.id IS NOT NULL AS linked, e.position
FROM msgs m LEFT JOIN owns o USING (id) LEFT JOIN quotes q USING (id) LEFT JOIN best b USING (id) LEFT JOIN before e USING (id)
)
SELECT *, CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN
  rank() OVER (PARTITION BY conv_id, turn IS NULL ORDER BY CASE WHEN parent_conv_id = conv_id THEN parent_turn END NULLS FIRST, turn) - 1 END AS reply_rank FROM told
"""
