"""Reply trees as conversations in a chat template, with a loss mask.

Iterated self-joins double each message's jump towards its root (its 1st, 2nd, 4th, ... ancestor), which gives root, depth and the sum of
scores of every branch in as many joins as the logarithm of the depth. Branches are ranked inside their tree, and the same jumps,
joined from the chosen leaves upward, list the messages of each chosen branch. Each branch becomes one conversation. Everything is DataFrame operations.

The template writes a turn as ``### role:``, a new line, the text and ``</turn>``; turns are parted by a new line. Inside roles and texts a
backslash is doubled, and another breaks every ``###`` and ``</turn>`` (in roles also a colon before a new line), so no control
string stands inside a text and reading is splitting. The loss mask has one span for each turn, in code points of the conversation, empty but for ``assistant``.

Null roles and texts count as empty, null scores as 0. A message without parent, or whose parent is no message, is a root; so is the
smallest of a cycle of replies. Messages may be repeated: answers go to the one that is first by its hash, then its row. Equal scores: the leaf that
is first. Other columns are ignored. One formatted conversation is one string: that of a branch must fit a task (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from adspark.llm.common import keep, table

OPEN, HEAD, CLOSE, TRAINED = "### ", ":\n", "</turn>", "assistant"
PROBE = "\\### Assistant: </turn> ok"


def escape(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(F.regexp_replace(text, "#(?=##)", r"#\\"), "<(?=/turn>)", r"<\\")
    return F.regexp_replace(text, r":(?=\n)", r":\\") if role else text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _links(messages: DataFrame) -> DataFrame:
    """node, parent (null at roots) and score of each row of ``messages``, which has a row number ``node``. Rows that answer nothing meet no others."""
    first = F.min(F.struct(F.xxhash64("role", "text").alias("hash"), "node"))
    named = messages.where("message_id IS NOT NULL").groupBy(F.col("message_id").alias("parent_id")).agg(first["node"].alias("parent"))
    scored = messages.select("node", "parent_id", F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)).alias("score"))
    replies = scored.where("parent_id IS NOT NULL").join(named, "parent_id", "left").select("node", "parent", "score")
    return replies.unionByName(scored.where("parent_id IS NULL").select("node", F.lit(None).cast("long").alias("parent"), "score"))


def _climb(links: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The links without cycles, the tables of jumps by 1, 2, 4, ... (node, up), and root, depth and total of each node.

    A cycle of replies keeps its nodes climbing; when they have gone further than there are messages, the smallest node of
    each cycle becomes a root and the climb starts again.
    """
    links = keep(links)
    count = links.count()
    now = keep(links.select("node", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth"),
                            F.col("node").alias("top"), F.col("parent").alias("low")))
    jumps, done = [], []
    while True:
        done.append(now.where("up IS NULL"))
        moving = now.where("up IS NOT NULL")
        if moving.isEmpty():
            break
        jumps.append(moving.select("node", "up"))
        if 1 << (len(jumps) - 1) > count:
            cut = moving.where("node = low").select("node", F.lit(True).alias("cut"))
            return _climb(links.join(cut, "node", "left").select("node", F.when(F.col("cut").isNull(), F.col("parent")).alias("parent"), "score"))
        target = now
        for part in done[:-1]:
            target = target.unionByName(part)
        target = target.select(F.col("node").alias("at"), F.col("up").alias("up2"), F.col("total").alias("total2"),
                               F.col("depth").alias("depth2"), F.col("top").alias("top2"), F.col("low").alias("low2"))
        now = keep(moving.join(target, F.col("up") == F.col("at")).select(
            "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("depth") + F.col("depth2")).alias("depth"),
            F.col("top2").alias("top"), F.least("low", "low2").alias("low")))
    reached = done[0]
    for part in done[1:]:
        reached = reached.unionByName(part)
    return links, jumps, reached.select("node", F.col("top").alias("root"), "depth", "total")


def branches(links: DataFrame, best: int) -> DataFrame:
    """The ``best`` branches of each tree by their sum of scores: root, leaf, rank, score, and for each message node and its place ``pos``."""
    links, jumps, reached = _climb(links)
    inner = links.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.lit(1).alias("inner"))
    order = Window.partitionBy("root").orderBy(F.desc("total"), "leaf")
    chosen = keep(reached.join(inner, "node", "left_anti").withColumnRenamed("node", "leaf")
                  .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best))
    path = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above"), "depth")
    for k, jump in enumerate(jumps):  # only nodes that have an ancestor so far up take part
        further = path.where(F.col("above") + (1 << k) < F.col("depth")).join(jump, "node").select(
            "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"), "depth")
        path = path.unionByName(keep(further))
    return path.join(chosen.drop("depth"), "leaf").select("root", "leaf", "rank", F.col("total").alias("score"), "node", (F.col("depth") - F.col("above") - 1).alias("pos"))


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """``message_id, parent_id, role, text, score`` (a reply names its parent) as conversations, the ``best`` branches of each tree.

    Returns tree (message_id of the root), leaf, rank, score, formatted and loss_mask (for each turn: code point where it starts, start and end of the trained span).
    """
    messages = keep(messages.select(
        "message_id", "parent_id", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("score").cast("double").alias("score"),
        F.monotonically_increasing_id().alias("node")))
    places = keep(branches(keep(_links(messages)), best))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(HEAD))
    turns = (messages.select("node", "message_id", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == TRAINED).alias("trained"))
             .join(places, "node").withColumn("size", F.length("head") + F.length("body") + len(CLOSE) + 1))
    before = Window.partitionBy("leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("turn", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))
    start = F.col("turn") + F.length("head")
    span = F.struct("turn", start.alias("start"), F.when(F.col("trained"), start + F.length("body")).otherwise(start).alias("end"))
    row = F.struct("pos", "message_id", F.concat("head", "body", F.lit(CLOSE)).alias("block"), span.alias("span"))
    whole = turns.groupBy("root", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return whole.select(F.col("rows")[0]["message_id"].alias("tree"), F.element_at("rows", -1)["message_id"].alias("leaf"), "rank", "score",
                        F.array_join("rows.block", "\n").alias("formatted"), F.col("rows.span").alias("loss_mask"))


def read_back(conversations: DataFrame) -> DataFrame:
    """The rows with ``turns``: role, text and the text under the loss mask of each turn, unescaped, from formatted and loss_mask alone."""
    pieces = F.split("formatted", CLOSE + r"\n?", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(x: Column) -> Column:
        piece, span = x["piece"], x["span"]
        colon = F.locate(HEAD, piece, len(OPEN) + 1)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, colon + len(HEAD), F.length(piece))).alias("text"),
            unescape(F.substring(piece, (span["start"] - span["turn"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))).alias("loss"))

    zipped = F.arrays_zip(pieces.alias("piece"), F.col("loss_mask").alias("span"))
    return conversations.withColumn("turns", F.transform(zipped, turn))


def as_replies(rows: DataFrame) -> DataFrame:
    """Rows of conversations by turn (null first, then role and text): each answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    name = lambda k: F.struct("conv_id", k.alias("k"))
    rows = rows.withColumn("k", F.row_number().over(order))
    return rows.select(name(F.col("k")).alias("message_id"), F.when(F.col("k") > 1, name(F.col("k") - 1)).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, written and read back."""
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"), F.lit(PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    found = read_back(keep(format_trees(as_replies(rows.unionByName(probe)))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("turns.loss", "")
    return found.select(F.col("tree.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH r AS (SELECT conv_id, turn, role AS ro, text AS tx, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, ro NULLS FIRST, tx NULLS FIRST) AS k,
  role || text AS said,
  length(role) - length(replace(role, chr(58) || chr(10), chr(58))) AS colons FROM r),
c AS (SELECT *, 13 + length(said) + colons + (length(said) - length(replace(said, '\', '')))
  + (length(text) - length(replace(text, '</turn>', '</turn'))) + (length(role) - length(replace(role, '</turn>', '</turn')))
  + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
  + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0) AS chars FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + count(*) - 1 AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
