"""Deterministic draws: samples of entities and negatives for observed pairs.

A draw is arithmetic on row numbers. Candidates are numbered inside their bucket, a request asks
for consecutive slots, and slot i of a work is candidate (start + i * STRIDE) mod size: distinct
slots give distinct candidates, so nothing is drawn twice and no list of candidates is ever built.
Rows meet by an equi-join on (bucket, number); a popular bucket is spread over all its numbers.

Steps of STRIDE visit every candidate of a bucket once. Laid out in that order, the candidates of
consecutive slots are neighbours: hard draws are asked for as runs and travel as lists (`_runs`).

Ranking reads its input twice, so inputs that are costly to derive are written to the shared
folder first (`cut`): each step is computed once, and a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.workspace import cut
from .ordering import ordered_blocks, rank_in_group
from .quality import union_all

# Ratio of negatives to positives, and the seed of every draw.
NEGATIVES_PER_POSITIVE = 4
SEED = 42

STRIDE = 2_147_483_647  # prime and larger than any bucket, so it shares no factor with its size
MIN_BLOCKS = 64
BLOCK_ROWS = 1_000_000  # rows of one bucket that a task numbers at a time
SLOT_BLOCK = 65_536
RUN = 256  # neighbouring candidates that are handed out together
WORK_ROWS = 20_000  # positives of a work up to which all its draws are ordered in one task

Hash = Callable[[Column], Column]


def seeded_hash(key: Column, seed: int = SEED) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(STRIDE))


def sample_entities(df: DataFrame, key: str, n: int, hash_of: Hash = seeded_hash) -> DataFrame:
    """n rows, the same ones in any run and any partitioning."""
    return df.orderBy(hash_of(F.col(key)), key).limit(n)


def shuffled(df: DataFrame, *keys: str, hash_of: Callable[..., Column] | None = None, name: str = "position") -> DataFrame:
    """`df` with each row's place (from 1) in a seeded random order of its unique keys. Places are
    counted in ordered blocks; no task orders all rows."""
    h = hash_of(*[F.col(k) for k in keys]) if hash_of else F.xxhash64(*keys, F.lit(SEED))
    order = [F.col("_h"), *[F.col(k) for k in keys]]
    blocked = ordered_blocks(df.withColumn("_h", h), order)
    return rank_in_group(blocked, [], "_block", order, name).drop("_h", "_block")


def _blocks(rows: int) -> int:
    """Hash blocks a bucket is cut into: enough for a bucket that holds every row."""
    return max(MIN_BLOCKS, rows // BLOCK_ROWS)


def numbered(
    df: DataFrame, bucket: list[str], key: str, hash_of: Hash, members: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Adds `_number` (from 0, in hash order within the bucket) and `_size` of the bucket.

    `members` makes rows of (bucket, key) out of `df` and keeps its further columns. A block is known by
    the key alone, so the narrower rows of `df` are dealt out and made into members where they are ranked.
    """
    df = cut(df, "to_number")
    blocks = _blocks((members(df) if members else df).count())  # one number
    hashed = df.withColumn("_h", hash_of(F.col(key))).withColumn("_b", F.pmod("_h", F.lit(blocks)))
    if members:
        hashed = members(hashed.repartition("_b"))
    ranked = rank_in_group(hashed, bucket, "_b", [F.col("_h"), F.col(key)], "_number", "_size")
    return ranked.withColumn("_number", F.col("_number") - 1).drop("_h", "_b")


def _slots(
    requests: DataFrame, pool: DataFrame, bucket: list[str], per_row: int, spread: bool = False
) -> DataFrame:
    """`per_row` slots for every positive, numbered through per (work, bucket): column `slot`. Slots
    beyond the bucket's size have no candidate and are left out; `_size` comes along.

    The slots of a group are all numbers below a count, so positives are counted, not ranked. `spread`
    deals the blocks of a group out before they are written down, for groups of very many slots.
    """
    group = list(dict.fromkeys(["work_key", *bucket]))
    asked = requests.groupBy(*group).agg((F.count(F.lit(1)) * per_row).alias("_end"))
    if bucket:
        sized = asked.join(pool.filter("_number = 0").select(*bucket, "_size"), bucket)
    else:
        size = pool.agg(F.max("_size")).first()[0]  # one bucket, one number
        sized = asked.withColumn("_size", F.lit(size or 0).cast("long"))
    sized = sized.withColumn("_end", F.least("_end", "_size")).filter("_end > 0")
    last = F.floor((F.col("_end") - 1) / SLOT_BLOCK)
    blocks = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_k"))
    if spread:
        blocks = blocks.repartition(*group, "_k")
    begin = F.col("_k") * SLOT_BLOCK
    until = F.least(F.col("_end"), begin + SLOT_BLOCK) - 1
    return blocks.select(*group, "_size", F.explode(F.sequence(begin, until)).alias("slot"))


def _draw(slots: DataFrame, pool: DataFrame, bucket: list[str], hash_of: Hash) -> DataFrame:
    """The candidate each slot points at.

    `pool` carries the bucket, award_key, _number and _size, and is stored already.
    """
    pointed = slots.withColumn(
        "_number",
        F.pmod(hash_of(F.col("work_key")) + F.col("slot") * F.lit(STRIDE), F.col("_size")),
    ).drop("_size")
    return pointed.join(pool.drop("_size"), [*bucket, "_number"]).drop("_number")


def _step_inverse(size: Column) -> Column:
    """The inverse of STRIDE modulo a bucket's size, by Euclid's algorithm: at most 46 steps below 2^31."""
    step = """aggregate(sequence(1, 46), named_struct('a', {0}, 'b', {1}L % {0}, 's', 0L, 't', 1L), (x, i) ->
        CASE WHEN x.b = 0 THEN x ELSE named_struct('a', x.b, 'b', x.a % x.b, 's', x.t, 't', x.s - (x.a DIV x.b) * x.t) END).s"""
    return F.pmod(F.expr(step.format("_size", STRIDE)), size)


def _runs(asked: DataFrame, candidates: DataFrame, hash_of: Hash) -> DataFrame:
    """The candidates of the slots below `_slots` of each (work_key, bucket): rows of work_key, bucket, the
    first `slot` of a run, and the list `awards` of its candidates.

    Slot i points at number start + i * STRIDE, so number n lies at place n / STRIDE modulo the size, and
    the slots of a work are neighbours on that ring. Blocks of RUN places meet the runs that cross them.
    The list of buckets, years times topics and countries, does not grow with awards or works: it is broadcast.
    """
    first = candidates.filter("_number = 0")
    sizes = F.broadcast(first.select("bucket", "_size", _step_inverse(F.col("_size")).alias("_inverse")))
    place = lambda n: F.pmod(n * F.col("_inverse"), F.col("_size"))
    ring = candidates.join(sizes.drop("_size"), "bucket").select("bucket", place(F.col("_number")).alias("_at"), "award_key")
    block = F.floor(F.col("_at") / RUN).alias("_k")
    blocks = ring.select("bucket", block, "_at", "award_key").repartition("bucket", "_k").groupBy("bucket", "_k").agg(
        F.sort_array(F.collect_list(F.struct("_at", "award_key")))["award_key"].alias("_block")
    )
    begun = asked.join(sizes, "bucket").select(
        "work_key", "bucket", "_size", place(F.pmod(hash_of(F.col("work_key")), F.col("_size"))).alias("_first"),
        F.least("_slots", "_size").alias("_n"),
    )
    none, end = F.lit(0).cast("long"), F.col("_first") + F.col("_n")
    spans = F.array(  # up to the end of the ring, and on from its beginning
        F.struct(F.col("_first").alias("_from"), F.least(end, F.col("_size")).alias("_to"), none.alias("_slot")),
        F.struct(none.alias("_from"), (end - F.col("_size")).alias("_to"), (F.col("_size") - F.col("_first")).alias("_slot")),
    )
    spanned = begun.select("work_key", "bucket", F.inline(spans)).filter("_to > _from")
    cuts = F.sequence(F.floor(F.col("_from") / RUN), F.floor((F.col("_to") - 1) / RUN))
    pieces = spanned.select("*", F.explode(cuts).alias("_k")).select(
        "work_key", "bucket", "_k", F.greatest("_from", F.col("_k") * RUN).alias("_low"),
        F.least("_to", (F.col("_k") + 1) * RUN).alias("_high"), (F.col("_slot") - F.col("_from")).alias("_shift"),
    )
    begin = (F.col("_low") - F.col("_k") * RUN + 1).cast("int")
    return pieces.join(blocks.hint("merge"), ["bucket", "_k"]).select(
        "work_key", "bucket", (F.col("_shift") + F.col("_low")).alias("slot"),
        F.slice("_block", begin, (F.col("_high") - F.col("_low")).cast("int")).alias("awards"),
    )


def _not_received(drawn: DataFrame, positives: DataFrame) -> DataFrame:
    return drawn.join(positives.select("work_key", "award_key"), ["work_key", "award_key"], "left_anti")


def _wanted(positives: DataFrame) -> DataFrame:
    return positives.groupBy("work_key").agg(F.count(F.lit(1)).alias("_n"))


def _first_by_slot(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    blocked = rows.withColumn("_b", F.floor(F.col("slot") / SLOT_BLOCK))
    return rank_in_group(blocked, ["work_key"], "_b", order, rank).drop("_b")


def random_negatives(
    positives: DataFrame, awards: DataFrame, hash_of: Hash = seeded_hash, ratio: int = NEGATIVES_PER_POSITIVE
) -> DataFrame:
    """`ratio` awards per positive that the work did not receive, drawn from all awards.

    One slot more per positive is drawn than needed. A work with n positives can lose at most n of
    its (ratio + 1) * n draws to awards it received, so enough remain whenever that many exist.
    """
    pool = cut(numbered(awards.select("award_key"), [], "award_key", hash_of), "pool")
    slots = _slots(positives, pool, [], ratio + 1, spread=True)
    drawn = cut(_not_received(_draw(slots, pool, [], hash_of), positives), "drawn")
    ranked = _first_by_slot(drawn, [F.col("slot")], "_rank").join(_wanted(positives), "work_key")
    return ranked.filter(F.col("_rank") <= F.col("_n") * ratio).select("work_key", "award_key")


def in_force_pool(awards: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """One row per award and year it is in force, for the years that have publications. An award
    without a first year is never in force; one without a last year stays open."""
    begins = F.greatest(F.col("first_year"), F.lit(first_year))
    ends = F.least(F.coalesce("last_year", F.lit(last_year)), F.lit(last_year))
    years = F.when(begins <= ends, F.sequence(begins, ends))
    kept = [c for c in awards.columns if c not in ("first_year", "last_year")]
    return awards.filter(F.col("first_year").isNotNull()).select(*kept, F.explode(years).alias("year"))


def hard_negatives(
    positives: DataFrame,
    awards: DataFrame,
    hash_of: Hash = seeded_hash,
    ratio: int = NEGATIVES_PER_POSITIVE,
    work_rows: int = WORK_ROWS,
) -> DataFrame:
    """`ratio` negatives per positive among awards in force in the publication year: half drawn at
    random, half sharing the publication's topic or the funder country of its positive.

    positives: work_key, award_key, year, topic, country
    awards: award_key, first_year, last_year (NULL = open), topic, country

    Where hard candidates run out, random ones fill in, and where those run out, spare hard ones.
    The random slots alone cover ratio * n awards not received whenever that many are in force.

    Draws cross the shuffle once, as lists: to their work, where they are compared with what the work
    received and ordered. Works of more than `work_rows` positives are ordered in blocks.
    """
    span = positives.agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
    if span["a"] is None:
        return positives.limit(0).select("work_key", "award_key", F.lit("").alias("kind"))
    bucket = lambda kind, *parts: F.concat_ws("|", F.lit(kind), *[F.col(p).cast("string") for p in parts])
    kinds = {"topic": ["year", "topic"], "country": ["year", "country"], "any": ["year"]}
    known = {k: F.col(parts[-1]).isNotNull() & F.col("year").isNotNull() for k, parts in kinds.items()}
    tags = F.filter(
        F.array(*[F.when(known[k], bucket(k, *parts)) for k, parts in kinds.items()]), lambda t: t.isNotNull()
    )

    def members(rows: DataFrame) -> DataFrame:
        more = [c for c in rows.columns if c not in awards.columns]
        return in_force_pool(rows, span["a"], span["b"]).select("award_key", F.explode(tags).alias("bucket"), *more)

    traits = awards.select("award_key", "first_year", "last_year", "topic", "country")
    candidates = cut(numbered(traits, ["bucket"], "award_key", hash_of, members), "candidates")

    def drawn(rows: DataFrame) -> DataFrame:
        """Runs of every slot that the works of `rows` ask for."""
        each = {"topic": ratio // 2, "country": ratio // 2, "any": ratio + ratio // 2}
        asked = [
            rows.filter(known[k]).select("work_key", bucket(k, *parts).alias("bucket")).groupBy("work_key", "bucket").agg(
                (F.count(F.lit(1)) * each[k]).alias("_slots")
            )
            for k, parts in kinds.items()
        ]
        return _runs(union_all(asked), candidates, hash_of)

    large = _wanted(positives).filter(F.col("_n") > work_rows).select("work_key")
    if large.isEmpty():
        return _tiers_by_work(drawn(positives), positives, ratio)
    large = cut(large, "large")
    few = positives.join(large, "work_key", "left_anti")
    many = positives.join(large, "work_key", "left_semi")
    return _tiers_by_work(drawn(few), few, ratio).unionByName(_tiers_in_blocks(drawn(many), many, ratio))


def _kind() -> Column:
    return F.when(F.col("tier") == 1, "random").otherwise("hard").alias("kind")


def _tiers_by_work(drawn: DataFrame, positives: DataFrame, ratio: int) -> DataFrame:
    """The first `ratio` negatives per positive of each work: half of them hard, then random ones, then
    spare hard ones, each by slot. What a work received meets its draws in the same shuffle."""
    random = F.col("bucket").startswith("any|").cast("long")
    received = F.lit(-1).cast("long")
    runs = drawn.select("work_key", (random * F.lit(1 << 48) + F.col("slot")).alias("_code"), "awards").unionByName(
        positives.select("work_key", received.alias("_code"), F.array("award_key").alias("awards"))
    )
    # As many tasks as the draws need, whatever the session's number: a task holds about BLOCK_ROWS of them.
    tasks = 1 + positives.count() * (2 * (ratio // 2) + ratio + ratio // 2 + 1) // BLOCK_ROWS
    rows = runs.repartition(tasks, "work_key").select("work_key", "_code", F.posexplode("awards").alias("_i", "award_key"))
    rows = rows.select("work_key", "award_key", (F.col("_code") + F.col("_i")).alias("_code"))
    best = rows.groupBy("work_key", "award_key").agg(
        F.min("_code").alias("_code"), F.count_if(F.col("_code") == received).alias("_copies")
    )
    # A work's hard draws come first in this order, so its places are theirs.
    by_slot = Window.partitionBy("work_key").orderBy("_code", "award_key")
    work = Window.partitionBy("work_key")
    is_hard = F.col("_code").between(0, (1 << 48) - 1)
    placed = best.select(
        "work_key", "award_key", "_code", is_hard.alias("_hard"),
        (F.row_number().over(by_slot) - F.sum((F.col("_code") < 0).cast("long")).over(work)).alias("_place"),
        F.sum("_copies").over(work).alias("_n"),
        F.count_if(is_hard).over(work).alias("_all_hard"),
        F.count_if(F.col("_code") >= 1 << 48).over(work).alias("_all_random"),
    ).filter(F.col("_code") >= 0)
    first_hard = F.least(F.col("_all_hard"), F.col("_n") * (ratio // 2))
    spare = F.col("_hard") & (F.col("_place") > first_hard)
    rank = (
        F.when(spare, F.col("_place") + F.col("_all_random"))
        .when(F.col("_hard"), F.col("_place"))
        .otherwise(F.col("_place") - F.col("_all_hard") + first_hard)
    )
    tier = F.when(spare, 2).when(F.col("_hard"), 0).otherwise(1)
    return placed.filter(rank <= F.col("_n") * ratio).withColumn("tier", tier).select("work_key", "award_key", _kind())


def _tiers_in_blocks(drawn: DataFrame, positives: DataFrame, ratio: int) -> DataFrame:
    """The same of works with very many positives, whose draws no task holds or orders as a whole."""
    is_any = F.col("bucket").startswith("any|")
    drawn = drawn.select("work_key", "bucket", "slot", F.posexplode("awards").alias("_i", "award_key"))
    drawn = drawn.withColumn("slot", F.col("slot") + F.col("_i"))
    best = drawn.groupBy("work_key", "award_key").agg(
        F.min(F.when(is_any, 1).otherwise(0)).alias("tier"),
        F.min(F.struct(F.when(is_any, 1).otherwise(0).alias("tier"), F.col("slot")))["slot"].alias("slot"),
    )
    fresh = cut(_not_received(best, positives).join(_wanted(positives), "work_key"), "fresh")
    order = [F.col("slot"), F.col("award_key")]
    hard = _first_by_slot(fresh.filter("tier = 0"), order, "_place")
    spare = F.col("_place") > F.col("_n") * (ratio // 2)
    hard = hard.withColumn("tier", F.when(spare, 2).otherwise(0)).drop("_place")
    both = hard.unionByName(fresh.filter("tier = 1")).withColumn(
        "_b", F.col("tier") * F.lit(1 << 32) + F.floor(F.col("slot") / SLOT_BLOCK)
    )
    chosen = rank_in_group(cut(both, "tiers"), ["work_key"], "_b", order, "_rank")
    return chosen.filter(F.col("_rank") <= F.col("_n") * ratio).select("work_key", "award_key", _kind())
