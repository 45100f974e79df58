"""Chat formatting after cumulative-snapshot collapse.

Loggers write a conversation again each time it grows, so most logged
conversations are prefixes of longer ones. A rolling hash of each turn prefix
finds them: the hash of a prefix is a sum over its turns of hashes that include
the turn's place, taken twice with 40 bits each. Conversations whose whole hash
is the hash of a proper prefix elsewhere are dropped by an anti-join, equal
conversations leave the smallest conv_id, and the rest is rendered.

Places and sums come from blocks of ``BLOCK`` turn numbers and then from block
totals, so a conversation with very many turns is spread over tasks; it is
rendered in parts of ``BLOCK`` turns too. Prefixes are counted with map-side
combining and meet one row per hash, so a first turn that many conversations
share is no hot key.

Defined results: turns are ordered by turn, role, text; exact repeats of a turn
row count once; null roles render as ``unknown`` and null texts as empty; a null
turn stands first; rows without conv_id belong to no conversation; an empty
table gives an empty result; only the named columns are read. Template markers
inside a text are broken up so that they stay text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.scratch import cut

BLOCK = 256
_BITS = 1 << 40


def turn_prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, pos (from 1), n (turns of the conversation), role, text, and the prefix hash (h1, h2) up to it."""
    base = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = base.distinct().withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("long"))
    block = Window.partitionBy("conv_id", "block")
    inside = block.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("rank", F.row_number().over(inside))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    counts = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.select("conv_id", "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("skip"), F.sum("c").over(whole).alias("n"))
    placed = rows.join(counts, ["conv_id", "block"]).withColumn("pos", F.col("rank") + F.col("skip"))
    own = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "pos", "role", "text"), F.lit(_BITS))
    placed = placed.withColumns({"t1": own(1), "t2": own(2)})
    sums = placed.groupBy("conv_id", "block").agg(F.sum("t1").alias("b1"), F.sum("t2").alias("b2"))
    sums = sums.select("conv_id", "block", *[F.coalesce(F.sum(f"b{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(sums, ["conv_id", "block"]).select("conv_id", "pos", "n", "role", "text", *[(F.sum(f"t{i}").over(upto) + F.col(f"b{i}")).alias(f"h{i}") for i in (1, 2)])


def maximal(prefixes: DataFrame) -> DataFrame:
    """Conversations to keep: conv_id (smallest of equals), n and n_equal. ``prefixes``: a stored result of :func:`turn_prefixes`."""
    ends = prefixes.filter(F.col("pos") == F.col("n")).groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    inner = prefixes.filter(F.col("pos") < F.col("n")).groupBy(F.col("pos").alias("n"), "h1", "h2").agg(F.lit(1).alias("_"))
    return ends.join(inner, ["n", "h1", "h2"], "left_anti").select("conv_id", "n", "n_equal")


def render(prefixes: DataFrame, keep: DataFrame) -> DataFrame:
    """ChatML text of the kept conversations in parts: conv_id, part (from 0), n_turns, n_equal, rendered."""
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    piece = F.concat(F.lit("<|im_start|>"), safe("role"), F.lit("\n"), safe("text"), F.lit("<|im_end|>\n"))
    part = F.floor((F.col("pos") - 1) / BLOCK).cast("long")
    turns = prefixes.select("conv_id", "pos", "n", piece.alias("piece")).join(keep.select("conv_id", "n_equal"), "conv_id")
    grouped = turns.groupBy("conv_id", part.alias("part"), F.col("n").alias("n_turns"), "n_equal").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("pieces"))
    return grouped.select("conv_id", "part", "n_turns", "n_equal", F.array_join(F.col("pieces.piece"), "").alias("rendered"))


def chat_format(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Collapse snapshots, then render what stays."""
    prefixes = cut(turn_prefixes(turns, conv_col, turn_col, role_col, text_col), "turns")
    return render(prefixes, maximal(prefixes))


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM t),
p AS (SELECT *, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM r),
ends AS (SELECT prefix, n, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE pos = n GROUP BY ALL),
keep AS (SELECT * FROM ends WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = ends.n AND p.prefix = ends.prefix))
SELECT conv_id, (pos - 1) // 256 AS part, r.n AS n_turns, n_equal,
  string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM r JOIN keep USING (conv_id) GROUP BY ALL
"""
