"""Chat formatting by cumulative-snapshot collapse (DataFrame operations only).

Chat logs often hold a conversation again and again, each time some turns longer. Rolling hashes of turn prefixes find
the logged conversations that are a prefix of a longer one; an anti-join keeps the maximal ones, which are then rendered.

A turn's hash covers its place in the conversation, role and text (128 bits, as four sums of 32 bits each); the hash of a prefix
is the running sum of its turns' hashes. Sums are taken within blocks of turns and over block totals, so one conversation of any
length is dealt to many tasks; its rendering comes in parts of as many turns. The texts move twice: by conversation and block to
be put in order (then they are written to the shared folder with their prefix hashes, which all later steps read), and to be
rendered, when only maximal conversations are left.

Defined results: rows equal in conv_id, turn, role and text count once; ties in turn are ordered by role and text, a null
turn stands last; a null role or text is ""; null conv_id is a conversation of its own; of equal conversations the one
with the least conv_id stays (a null one last). Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import written

#: Turns of a block and of a rendered part.
BLOCK = 256


#: Stands for a null turn's block, after all others.
LAST = (1 << 63) - 1
KEY = ("conv", "nameless")
LANES = ("h1", "h2", "h3", "h4")


def prefixes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv and nameless (conv_id as two columns without nulls), role, text, pos (from 1), n_turns (of the conversation), h1 .. h4:
    the hash of the turns up to this one."""
    own = F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("nameless")
    at = F.coalesce(F.floor(F.col("turn") / block), F.lit(LAST)).alias("block")
    t = conversations.select(*own, at, "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.repartition(*KEY, "block").distinct()  # by the same key as the window and the joins below: texts are shuffled once
    by_block = (*KEY, "block")
    t = t.withColumn("nth", F.row_number().over(Window.partitionBy(*by_block).orderBy(F.col("turn").isNull(), "turn", "role", "text")))
    before = Window.partitionBy(*KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = t.groupBy(*by_block).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(*by_block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.sum("n").over(Window.partitionBy(*KEY)).alias("n_turns"))
    t = t.join(counts, list(by_block)).withColumn("pos", F.col("n0") + F.col("nth"))
    one, two = F.xxhash64("pos", "role", "text"), F.xxhash64(F.lit(7), "text", "role", "pos")
    halves = [h for x in (one, two) for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))]
    t = t.select(*by_block, "role", "text", "pos", "n_turns", *[h.alias(name) for h, name in zip(halves, LANES, strict=True)])
    sums = t.groupBy(*by_block).agg(*[F.sum(h).alias(f"s{h}") for h in LANES])
    sums = sums.select(*by_block, *[F.coalesce(F.sum(f"s{h}").over(before), F.lit(0)).alias(f"a{h}") for h in LANES])
    within = Window.partitionBy(*by_block).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return t.join(sums, list(by_block)).select(*KEY, "role", "text", "pos", "n_turns", *[(F.col(f"a{h}") + F.sum(h).over(within)).alias(h) for h in LANES])


def maximal(turns: DataFrame) -> DataFrame:
    """conv, nameless of the conversations that no longer one extends; turns: from prefixes()."""
    prefix = ["pos", *LANES]
    whole = turns.filter("pos = n_turns").groupBy(*prefix).agg(F.min(F.struct("nameless", "conv")).alias("first"))
    inner = turns.filter("pos < n_turns").select(*prefix).distinct()
    return whole.join(inner, prefix, "left_anti").select("first.conv", "first.nameless")


def render(turns: DataFrame, kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, part, n_turns (of the conversation), text: turns as <|role|>, line feed, text, line feed."""
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n"))
    parts = turns.join(kept, list(KEY)).withColumn("part", F.floor((F.col("pos") - 1) / block))
    return parts.groupBy(*KEY, "part", "n_turns").agg(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines")).select(
        F.when(~F.col("nameless"), F.col("conv")).alias("conv_id"), "part", "n_turns", F.array_join(F.col("lines.line"), "").alias("text")
    )


def format_chats(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    turns = written(prefixes(conversations, block), "turns")
    return render(turns, maximal(turns), block)


ORACLE = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (
  SELECT conv_id, list('<|' || role || '|>' || chr(10) || text || chr(10) ORDER BY turn IS NULL, turn, role, text) AS l FROM t GROUP BY 1),
u AS (SELECT min(conv_id) AS conv_id, l FROM c GROUP BY l),
i AS (SELECT DISTINCT l[:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM u)),
k AS (SELECT u.conv_id, u.l FROM u ANTI JOIN i ON u.l = i.l),
p AS (SELECT conv_id, l, unnest(range(0, (len(l) + {BLOCK - 1}) // {BLOCK})) AS part FROM k)
SELECT conv_id, part::BIGINT AS part, len(l)::BIGINT AS n_turns, array_to_string(l[part * {BLOCK} + 1:(part + 1) * {BLOCK}], '') AS text FROM p
"""
