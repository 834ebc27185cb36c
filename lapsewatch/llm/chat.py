"""Chat formatting of reply trees; DataFrame functions only.

Every message points at the one it answers. Pointer doubling (self-joins over ancestors at distance 1, 2, 4, ...) finds
the root, depth and score of each leaf's path, branches are ranked by score, and the same tables, walked from the
farthest to the nearest, list the messages of each chosen path: a thread of 400 messages takes 9 joins, not 400.

Template: ``<|turn|>role\\ntext<|end|>\\n`` for each turn. Inside roles and texts a backslash follows every ``<``, ``[`` and
backslash, so no marker, tag or instruction bracket can occur there; a line feed inside a role is written ``<n>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import stored, table

TURN, END = "<|turn|>", "<|end|>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def formatted(turns: Column) -> Column:
    """One string for an array of (role, text)."""
    def one(t: Column) -> Column:
        role = F.replace(escape(F.coalesce(t["role"], F.lit(""))), F.lit("\n"), F.lit("<n>"))
        return F.concat(F.lit(TURN), role, F.lit("\n"), escape(F.coalesce(t["text"], F.lit(""))), F.lit(END))

    return F.array_join(F.transform(turns, one), "")


def parsed(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    def one(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(unescape(F.replace(role, F.lit("<n>"), F.lit("\n"))).alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, r"<\|turn\|>")
    return F.transform(F.slice(pieces, 2, F.size(pieces)), one)


def _doubled(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables k = 0, 1, ...: (conv, msg, up, steps, score) of the messages that have an ancestor 2 ** k steps up, with the length
    and score of the way to it; and (conv, msg, steps, score) of the whole way up for messages below a root.

    A table holds only messages that deep, so short threads leave the joins after a few rounds.
    """
    start = stored(nodes.select("conv", "msg", F.col("parent").alias("up"), F.lit(1).alias("steps"), "score"))
    levels, rooted = [start.where("up IS NOT NULL")], start.where("up IS NULL")
    most = nodes.count()
    while levels[-1].limit(1).count() and 2 ** (len(levels) - 1) <= most:
        now = levels[-1]
        then = now.unionByName(rooted).select("conv", F.col("msg").alias("up"), F.col("up").alias("up2"),
                                              F.col("steps").alias("steps2"), F.col("score").alias("score2"))
        longer = stored(now.join(then, ["conv", "up"]).select(
            "conv", "msg", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("score") + F.col("score2")).alias("score")))
        levels.append(longer.where("up IS NOT NULL"))
        rooted = rooted.unionByName(longer.where("up IS NULL"))
    return levels, rooted.drop("up")


def reply_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """The ``top`` best root-to-leaf paths of each tree: (conv, leaf, rank, path_score, place, role, text), one row per message.

    ``messages``: conv, msg, parent, role, text, score. A message whose parent is null or unknown is a root. Branches are
    ranked in each conversation by the sum of their scores (null: 0), ties by the smaller leaf. Rows that repeat a message
    id count once, the smallest (parent, role, text, score). A message on or below a cycle is on no path. ``conv`` must not be null. An
    empty table gives no rows.
    """
    row = F.struct("parent", "role", "text", "score")
    once = messages.groupBy("conv", "msg").agg(F.min(row).alias("r")).select("conv", "msg", "r.*")
    ids = once.select("conv", F.col("msg").alias("parent"), F.lit(True).alias("_known"))
    nodes = once.join(ids, ["conv", "parent"], "left").select(
        "conv", "msg", F.when(F.col("_known"), F.col("parent")).alias("parent"), F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score"))
    nodes = stored(nodes)
    levels, rooted = _doubled(nodes)
    parents = nodes.where("parent IS NOT NULL").select("conv", F.col("parent").alias("msg")).distinct()
    leaves = rooted.join(parents, ["conv", "msg"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "msg"))
    best = leaves.withColumn("rank", rank)
    if top is not None:
        best = best.where(F.col("rank") <= top)
    best = stored(best.select("conv", F.col("msg").alias("leaf"), "rank", F.col("score").alias("path_score"), "steps"))
    path = best.select("conv", "leaf", F.col("leaf").alias("msg"), F.lit(0).alias("above"))
    for k in range(len(levels) - 1, -1, -1):
        jump = levels[k].select("conv", "msg", "up")
        path = path.unionByName(path.join(jump, ["conv", "msg"]).select(
            "conv", "leaf", F.col("up").alias("msg"), (F.col("above") + 2 ** k).alias("above")))
        path = stored(path) if k % 4 == 0 else path
    content = once.select("conv", "msg", "role", "text")
    return path.join(best, ["conv", "leaf"]).join(content, ["conv", "msg"]).select(
        "conv", "leaf", "rank", "path_score", (F.col("steps") - F.col("above")).alias("place"), "role", "text")


def format_paths(paths: DataFrame) -> DataFrame:
    """(conv, leaf, rank, path_score, formatted). A conversation becomes one text, so its turns meet in one task."""
    turns = F.sort_array(F.collect_list(F.struct("place", "role", "text")))
    return paths.groupBy("conv", "leaf", "rank", "path_score").agg(turns.alias("turns")).select(
        "conv", "leaf", "rank", "path_score", formatted(F.col("turns")).alias("formatted"))


def threads(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it by turn (null first), role and text."""
    order = Window.partitionBy("conv").orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first())
    keyed = rows.select(F.coalesce(F.col(conv).cast("string"), F.lit("\u0000")).alias("conv"), turn, role, text)
    numbered = keyed.withColumn("msg", F.row_number().over(order))
    return numbered.select("conv", "msg", (F.col("msg") - 1).alias("parent"), F.col(role).alias("role"), F.col(text).alias("text"),
                           F.lit(0.0).alias("score"))


def digest(chats: DataFrame) -> DataFrame:
    """What the formatted texts say, read back from them."""
    turns = chats.withColumn("turns", parsed(F.col("formatted")))
    everything = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LEARNED_ROLE), lambda t: t["text"]), "")
    return turns.withColumn("learned", learned).select(
        "conv", F.size("turns").cast("long").alias("n_turns"), F.sha2(everything, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings of a chat template. Null ids are one conversation."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = format_paths(reply_paths(threads(rows.unionByName(extra))))
    return digest(chats).withColumn("conv_id", F.expr("try_cast(conv AS BIGINT)")).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, turn, role, text, coalesce(role, '') AS r, coalesce(text, '') AS x FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
       CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(17 + length(replace(regexp_replace(r, '([<\[\\])', '\1\\', 'g'), chr(10), '<n>'))
                + length(regexp_replace(x, '([<\[\\])', '\1\\', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
