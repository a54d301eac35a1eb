"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source has a size (words of its documents) and a target.  The targets
become integer numbers of equal blocks of ``block`` words: the sources, and
then the shards of each source, receive blocks one by one in order of their
highest quotients v / (2k + 1).  A shard is a bounded hash slice of one source,
so a source that holds a third of all rows is many shards.  Inside a shard the
documents stand on a line in seeded order; the line is read twice, cut into
blocks (the last one may be shorter), and the shard's quota of blocks is drawn by
seeded hash, those of the first reading before those of the second and a short last
block only with all others.  Blocks of a quota
that a shard does not have go to other shards of its source.  A document's
``taken`` words are its overlap with the drawn blocks, hence at most twice its size.

Everything is DataFrame functions; all draws are MD5 of ids and the seed, so
reruns and recomputed partitions agree.

Defined cases: a null or wordless text has size 0 and takes 0; the null source
is a source of its own, last in order; rows with equal or null ``doc_id`` are
separate rows (order among equal rows is immaterial to the counts only when
they are equal in size too; size breaks the tie); an empty table gives an empty
result; when all sizes are zero all targets are zero.  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
BLOCK = 128
SHARD_WORDS = 262_144
SEED = 20


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, source_size)``.

    Sources by code point (null last) weigh ``weights``, repeating, and share
    ``budget`` times all sizes.  No target exceeds ``most`` times its source's
    size; what is cut is shared among the others by weight until none is above.
    That fixed point is the water level L with target = min(most * size, L * weight):
    in order of cap per weight, a source is cut while the level that would serve it
    and all later ones is above its cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.select(
        "source", "source_size", "w", "cap",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cut"),
        F.sum("w").over(rest).alias("w_rest"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
    )
    at = (F.col("total") * F.lit(float(budget)) - F.col("cut")) / F.col("w_rest")
    rows = rows.withColumn("at", at).withColumn("above", F.col("at") * F.col("w") > F.col("cap"))
    # The first source below its cap fixes the level for itself and all after it.
    rows = rows.withColumn("level", F.min_by(F.when(~F.col("above"), F.col("at")), F.when(~F.col("above"), F.col("cap") / F.col("w"))).over(Window.partitionBy()))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return rows.select("source", "source_size", target.alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], name: str, votes: str, seats: str, out: str) -> DataFrame:
    """Integer ``out`` per party: each group's ``seats`` go to the highest quotients votes / (2k + 1).

    With n parties, V votes and Q seats of a group, a party surely holds its
    seats at the divisor V / (Q - n/2) and surely not more than at
    V / (Q + n/2); only the quotients between the two bounds (n per group in
    all) are ranked.  Ties go to the smaller name, null last.
    """
    whole = Window.partitionBy(*group)
    n, v, q = F.col("__n"), F.col("__v"), F.col(seats)
    rows = parties.withColumn("__n", F.count("*").over(whole)).withColumn("__v", F.sum(votes).over(whole).cast("double"))
    share = F.when(v > 0, F.col(votes) / v).otherwise(F.lit(0.0))
    sure = F.greatest(F.floor(share * (q - n / 2) + F.lit(0.5)) - 1, F.lit(0))
    upper = F.floor(share * (q + n / 2) + F.lit(0.5)) + 1
    rows = rows.withColumn("__sure", F.when(F.col(votes) > 0, sure).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("__upper", F.when(F.col(votes) > 0, upper).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("__left", q - F.sum("__sure").over(whole))
    open_seats = rows.where("__upper > __sure").withColumn("__k", F.explode(F.sequence("__sure", F.col("__upper") - 1)))
    ranked = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("__k") + 1)).desc(), F.col(name).asc_nulls_last())
    won = open_seats.withColumn("__r", F.row_number().over(ranked)).where("__r <= __left")
    keys = [*group, name]
    won = won.groupBy(*keys).agg(F.count("*").alias("__won"))
    won = won.select(*[F.col(k).alias(f"__{k}") for k in keys], "__won")
    joined = rows.join(won, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left")
    return joined.select(*parties.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).cast("long").alias(out))


def held_quotas(shards: DataFrame, block: int, most: int) -> DataFrame:
    """``shards`` with ``last``, the blocks of its line, and ``blocks`` held to it; what is over goes to the source's first shards with room."""
    rows = shards.withColumn("last", F.ceil(F.col("shard_size") * most / block))
    rows = rows.withColumn("__over", F.greatest(F.col("blocks") - F.col("last"), F.lit(0))).withColumn("__room", F.greatest(F.col("last") - F.col("blocks"), F.lit(0)))
    source, before = Window.partitionBy("source"), Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    more = F.greatest(F.least(F.sum("__over").over(source) - F.coalesce(F.sum("__room").over(before), F.lit(0)), "__room"), F.lit(0))
    return rows.withColumn("blocks", F.least("blocks", "last") + more).drop("__over", "__room")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: int = MOST, block: int = BLOCK,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``, one row per row of ``docs(doc_id, text, source)``."""
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most)
    # 1. blocks to sources by highest quotients
    goal = goal.withColumn("seats", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long"))
    goal = stored(sainte_lague(goal.withColumn("one", F.lit(1)), ["one"], "source", "target", "seats", "quota").drop("seats"), "mix-goal")
    # 2. bounded shards of every source, and their quotas
    rows = sized.join(goal.select(F.col("source").alias("s"), "source_size", "target", "quota"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    draw = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(str(seed))).cast("binary"))
    slices = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    rows = rows.withColumn("draw", draw).withColumn("shard", F.pmod(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long"), slices))
    line = Window.partitionBy("source", "shard").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("until", F.sum("size").over(line)).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "mix-line")
    shards = rows.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("quota"))
    shards = sainte_lague(shards, ["source"], "shard", "shard_size", "quota", "blocks").where("shard_size > 0")
    shards = stored(held_quotas(shards, block, most), "mix-shards")
    # 3. seeded choice of the blocks of the line, read `most` times; the shards are dealt out before they become blocks
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = F.md5(F.concat_ws(":", F.coalesce("source", F.lit("null")), "shard", "block", F.lit(str(seed))).cast("binary"))
    cut = shards.repartition(width, "source", "shard").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last") - 1)))
    cut = cut.withColumn("lap", F.floor(F.col("block") * block / F.col("shard_size"))).withColumn("name", named)
    short = (F.col("block") == F.col("last") - 1) & (F.col("last") * block > F.col("shard_size") * most)  # drawn when all are
    order = Window.partitionBy("source", "shard").orderBy(short, "lap", "name", "block")
    drawn = cut.withColumn("r", F.row_number().over(order)).where(F.col("r") <= F.col("blocks"))
    drawn = drawn.select(F.col("source").alias("s"), F.col("shard").alias("h"), F.col("block").alias("b"))
    # 4. overlap of each document's stretches (one per reading) with the drawn blocks
    size_of = shards.select(F.col("source").alias("s"), F.col("shard").alias("h"), "shard_size")
    put = rows.where("size > 0").join(size_of, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h"))).drop("s", "h")
    put = put.withColumn("reading", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    put = put.withColumn("hi", F.col("until") + F.col("reading") * F.col("shard_size")).withColumn("lo", F.col("hi") - F.col("size"))
    put = put.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    put = put.select("row", "source", "shard", "block", "lo", "hi")
    # blocks grow with the words: both sides are merged, neither is broadcast
    hit = put.join(drawn.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")) & (F.col("block") == F.col("b")))
    words = F.least("hi", (F.col("block") + 1) * block) - F.greatest("lo", F.col("block") * block)
    taken = hit.groupBy("row").agg(F.sum(words).alias("got"))
    out = rows.join(taken, "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("long").alias("taken"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: The same rows in DuckDB; the shares are apportioned there by ranking every quotient.
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source,
         coalesce(length(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':{SEED}') AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
g AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target
      FROM (SELECT *, (SELECT arg_min(lev, cap / w) FROM l WHERE lev * w <= cap) AS level FROM l)),
q AS (SELECT *, round(sum(target) OVER () / {BLOCK})::BIGINT AS seats FROM g),
qs AS (SELECT source, count(*) AS quota FROM (
         SELECT source, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS r
         FROM (SELECT *, unnest(range(0, ceil(target / {BLOCK})::BIGINT + 3)) AS k FROM q WHERE target > 0))
       WHERE r <= seats GROUP BY source),
x AS (SELECT d.*, g.source_size, g.target, coalesce(qs.quota, 0) AS quota,
        ('0x' || substr(draw, 1, 8))::BIGINT % greatest(ceil(g.source_size / {SHARD_WORDS}.0)::BIGINT, 1) AS shard
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN qs ON d.source IS NOT DISTINCT FROM qs.source),
y AS (SELECT *, (sum(size) OVER (PARTITION BY source, shard ORDER BY draw, size ROWS UNBOUNDED PRECEDING))::BIGINT AS until FROM x),
h AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, any_value(quota) AS quota FROM y GROUP BY source, shard),
h0 AS (SELECT h.source, h.shard, h.shard_size, ceil(h.shard_size * 2 / {BLOCK}.0)::BIGINT AS last, coalesce(z.blocks, 0) AS blocks FROM h LEFT JOIN (
         SELECT source, shard, count(*) AS blocks FROM (
           SELECT *, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard) AS r
           FROM (SELECT *, unnest(range(0, 2 * ceil(shard_size / {BLOCK}.0)::BIGINT + 3)) AS k FROM h WHERE shard_size > 0))
         WHERE r <= quota GROUP BY source, shard) z ON h.source IS NOT DISTINCT FROM z.source AND h.shard = z.shard WHERE h.shard_size > 0),
hs AS (SELECT source, shard, shard_size, last, least(blocks, last) + greatest(least(
         sum(greatest(blocks - last, 0)) OVER (PARTITION BY source)
         - coalesce(sum(greatest(last - blocks, 0)) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0),
         greatest(last - blocks, 0)), 0) AS blocks FROM h0),
b AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY source, shard ORDER BY block = last - 1 AND last * {BLOCK} > shard_size * 2, (block * {BLOCK}) // shard_size,
            md5(coalesce(source, 'null') || ':' || shard || ':' || block || ':{SEED}'), block) AS r
        FROM (SELECT *, unnest(range(0, last)) AS block FROM hs))
      WHERE r <= blocks),
p AS (SELECT y.row, y.source, y.shard, y.until + e.e * h.shard_size AS hi, y.until + e.e * h.shard_size - y.size AS lo
      FROM y JOIN h ON y.source IS NOT DISTINCT FROM h.source AND y.shard = h.shard, (SELECT unnest([0, 1]) AS e) e WHERE y.size > 0),
c AS (SELECT *, unnest(range(lo // {BLOCK}, (hi - 1) // {BLOCK} + 1)) AS block FROM p),
t AS (SELECT c.row, sum(least(hi, (c.block + 1) * {BLOCK}) - greatest(lo, c.block * {BLOCK})) AS got
      FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source AND c.shard = b.shard AND c.block = b.block GROUP BY c.row)
SELECT y.doc_id, y.size, y.source_size, y.target, coalesce(t.got, 0)::BIGINT AS taken FROM y LEFT JOIN t ON y.row = t.row
"""
