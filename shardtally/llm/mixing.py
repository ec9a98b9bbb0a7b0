"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a line of words: its documents in hashed order, one behind the other, cut into
blocks of ``BLOCK`` words. The schedule gives slot n to the source in whose share of [0, 1) the n-th
golden-ratio point falls; the j-th slot of a source takes its j-th block in shuffled order, starting
over when all have been taken, until the source has its target (the last slot may take part of a
block). Ranks and running sums over a source are made in two levels, within short stretches and over
the stretches' totals, so that a source with most of the rows is no single task.
Only DataFrame operations are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardtally.llm.common import WORD, row_key
from shardtally.sources.workspace import stored

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 256
#: After so many slots the points repeat: sources keep their shares, since each period has them.
PERIOD = 2**31
#: An odd number next to PERIOD times the golden ratio's fraction.
GOLDEN = 1327217885
CELLS = 4096
#: A whole copy in the running sums of shares of copies.
UNIT = 2**32
#: Multipliers that shuffle block numbers: primes, of which one at least divides no block count.
PRIMES = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121, 1000133, 1000151, 1000159)


def _stretch(rows: int, least: int) -> int:
    """Bits of a stretch's length: about the square root of the rows, ``least`` bits at least."""
    return max(least, math.ceil(math.log2(max(rows, 1)) / 2))


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size`` with ``sid`` (place in code point order, null last) and ``target`` in words.

    Shares go by weight; a source stops at ``most`` times its size, and what it leaves is shared by
    the others. Sorted by the size that a unit of weight allows, the sources that stop come first.
    One row per source is all that these windows see.
    """
    rows = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    rows = rows.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    everything = Window.partitionBy(F.lit(1))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "sid")
    before, onwards = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("_all", F.sum("source_size").over(everything))
    rows = rows.withColumn("_rest", F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
    stops = F.col("_cap") * F.sum("_w").over(onwards) < F.col("_w") * F.col("_rest")
    rows = rows.withColumn("_stops", stops)
    left = F.col("_all") - F.sum(F.when(F.col("_stops"), F.col("_cap")).otherwise(0)).over(everything)
    shared = F.sum(F.when(F.col("_stops"), 0).otherwise(F.col("_w"))).over(everything)
    target = F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(F.col("_w") * left.cast("double") / shared)
    return rows.select("source", "source_size", "sid", target.alias("target"))


def plans(sources: DataFrame, block: int) -> DataFrame:
    """For each source that takes words: its blocks, their shuffle, and how many slots reach its target."""
    size = F.col("source_size")
    rows = sources.withColumn("goal", F.round("target").cast("long")).where("goal > 0")
    rows = rows.withColumn("blocks", F.ceil(size / block).cast("long"))
    factor = F.coalesce(*[F.when(F.col("blocks") % p != 0, F.lit(p)) for p in PRIMES], F.lit(1)).cast("long")
    rows = rows.withColumn("factor", factor).withColumn("shift", F.pmod(F.xxhash64("sid"), "blocks"))
    last = F.pmod(F.col("factor") * (F.col("blocks") - 1) + F.col("shift"), F.col("blocks"))
    rows = rows.withColumn("_short_at", last).withColumn("_short", size - (F.col("blocks") - 1) * block)
    rows = rows.withColumn("_rest", F.col("goal") % size)
    until = F.ceil(F.col("_rest") / block)
    after = F.greatest(F.ceil((F.col("_rest") - F.col("_short")) / block), F.col("_short_at")) + 1
    rows = rows.withColumn("_part", F.when(until <= F.col("_short_at"), until).otherwise(after).cast("long"))
    full = F.expr("goal div source_size") * F.col("blocks")
    gone = F.col("_part") - 1
    words_before = F.when(gone <= F.col("_short_at"), gone * block).otherwise((gone - 1) * block + F.col("_short"))
    rows = rows.withColumn("slots", full + F.when(F.col("_rest") > 0, F.col("_part")).otherwise(0))
    rows = rows.withColumn("last_words", F.when(F.col("_rest") > 0, F.col("_rest") - words_before).otherwise(F.lit(block)))
    upto = F.sum("slots").over(Window.orderBy("sid"))
    rows = rows.withColumn("_upto", upto).withColumn("_slots", F.sum("slots").over(Window.partitionBy(F.lit(1))))
    rows = rows.withColumn("from_point", F.floor((F.col("_upto") - F.col("slots")) / F.col("_slots") * PERIOD))
    rows = rows.withColumn("to_point", F.floor(F.col("_upto") / F.col("_slots") * PERIOD))
    return rows.select("sid", "blocks", "factor", "shift", "slots", "last_words", "from_point", "to_point")


def schedule(plan: DataFrame) -> DataFrame:
    """``n, sid, j``: slot n takes the j-th block of source sid.

    A source's slots beyond its target are left out; what the points have left it short of (they
    keep within a few slots of its share) follows at the end.
    """
    spark = plan.sparkSession
    total = plan.agg(F.sum("slots")).first()[0] or 0
    bits = _stretch(total, 10)
    width = PERIOD // CELLS
    cell = F.explode(F.sequence(F.expr(f"from_point div {width}"), F.expr(f"(to_point - 1) div {width}")))
    cells = plan.where("from_point < to_point").select("sid", "slots", "from_point", "to_point", cell.alias("cell"))
    points = spark.range(total).select(F.col("id").alias("n"), ((F.col("id") % PERIOD) * GOLDEN % PERIOD).alias("point"))
    hits = points.withColumn("cell", F.expr(f"point div {width}")).join(cells, "cell").where("point >= from_point and point < to_point")
    hits = hits.select("n", "sid", "slots", F.shiftright("n", bits).alias("_part"))
    parts = hits.groupBy("sid", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("sid", "_part").orderBy("n"))
    ranked = hits.withColumn("_in", inside).join(parts, ["sid", "_part"])
    ranked = ranked.select("n", "sid", (F.col("_before") + F.col("_in") - 1).alias("j"), "slots").where("j < slots")
    got = hits.groupBy("sid").agg(F.count("*").alias("_got"))
    short = plan.select("sid", "slots").join(got, "sid", "left").withColumn("_got", F.coalesce("_got", F.lit(0))).where("_got < slots")
    tail = short.select((F.lit(total)).alias("n"), "sid", F.explode(F.sequence("_got", F.col("slots") - 1)).alias("j"))
    return ranked.select("n", "sid", "j").union(tail)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs`` (doc_id, source, text), with ``_k1, _k2`` (see ``row_key``).

    Size is the number of words of the whole text; null and blank texts have none and are never taken. A null
    source is a source. Repeated rows are taken as separate documents, null ids too. No document is taken more
    than ``most`` times; a source's taken words equal its target, rounded. Reruns agree.
    Other columns are not looked at; an empty table gives an empty result.
    """
    return _mix(docs, weights, most, block)[0].drop("sid")


def _mix(docs: DataFrame, weights: tuple, most: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``mix`` with ``sid``, and the table of ``targets``."""
    # null ids are told apart by their texts, so that they do not all lie in one stretch
    order = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit(11))).otherwise(F.xxhash64("text", F.lit(11)))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"), order.alias("_h"), *row_key())
    sized = stored(sized, "sizes")
    sources = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "sources")
    plan = stored(plans(sources, block), "plan")

    bits = min(62, max(1, math.ceil(math.log2(max(sized.count(), 1))) - _stretch(sized.count(), 8)))
    rows = sized.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_bucket", F.shiftright("_h", 64 - bits))
    inside = Window.partitionBy("sid", "_bucket").orderBy("_h", "doc_id", "size", "_k2")
    parts = rows.groupBy("sid", "_bucket").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("sid").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = rows.withColumn("_row", F.row_number().over(inside)).withColumn("_in", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.join(parts, ["sid", "_bucket"]).withColumn("_from", F.col("_before") + F.coalesce("_in", F.lit(0)))

    touched = F.sequence(F.expr(f"_from div {block}"), F.expr(f"(_from + size - 1) div {block}"))
    pieces = rows.withColumn("_block", F.explode_outer(F.when(F.col("size") > 0, touched)))
    pieces = pieces.withColumn("_lo", F.greatest(F.lit(0), F.col("_from") - F.col("_block") * block))
    pieces = pieces.withColumn("_hi", F.least(F.lit(block), F.col("_from") + F.col("size") - F.col("_block") * block))
    shuffles = plan.select("sid", "blocks", "factor", "shift")
    pieces = pieces.join(shuffles, "sid", "left").withColumn("_at", F.pmod(F.col("factor") * F.col("_block") + F.col("shift"), F.col("blocks")))

    slots = schedule(plan).join(plan.select("sid", "blocks", "slots", "last_words"), "sid")
    slots = slots.groupBy("sid", (F.col("j") % F.col("blocks")).alias("_at")).agg(
        F.count_if(F.col("j") < F.col("slots") - 1).alias("_times"),
        F.max(F.when(F.col("j") == F.col("slots") - 1, F.col("last_words")).otherwise(0)).alias("_words"),
    )
    words = F.col("_times") * (F.col("_hi") - F.col("_lo")) + F.greatest(F.lit(0), F.least("_hi", "_words") - F.col("_lo"))
    taken = pieces.join(slots, ["sid", "_at"], "left").withColumn("_taken", F.coalesce(words, F.lit(0)))
    keys = ["sid", "_bucket", "_row", "doc_id", "size", "source_size", "target", "_k1", "_k2"]
    taken = taken.groupBy(keys).agg(F.sum("_taken").cast("long").alias("taken"))
    return taken.select("sid", "doc_id", "size", "source_size", "target", "taken", "_k1", "_k2"), sources


def _before(rows: DataFrame, keys: list[str], inner: list[str | Column], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of the same ``keys`` that come before by ``inner``."""
    window = Window.partitionBy(*keys).orderBy(*inner).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(window), F.lit(0)))


def whole_copies(taken: DataFrame) -> DataFrame:
    """``sid, _k1, _k2, _rows, _copies``: how many whole copies stand for the words ``taken`` of each document of ``_mix``.

    A document gets taken div size copies; what is left of it is a share p < 1 of one more. Down a
    source's documents, largest first, one gets that copy where the running sum of p passes a half, one and
    a half, ... The copies given are then never more than half a copy ahead of or behind p, and as sizes
    only fall along the way, a source's words end within half its largest document of what ``mix`` takes.
    Repeated rows are one document of ``_rows`` rows. p is counted in units of 1/UNIT; its sums
    are made within stretches of one size, over the stretches and over the sizes.
    """
    groups = taken.where("size > 0").groupBy("sid", "size", "_k1", "_k2").agg(F.sum("taken").alias("_taken"), F.count("*").alias("_rows"))
    share = F.expr(f"(_taken % size) * {UNIT} div size")
    groups = groups.withColumns({"_full": F.expr("_taken div size"), "_p": share, "_h": F.xxhash64("_k1", "_k2")})
    groups = stored(groups.where("_taken > 0"), "shares")
    groups = groups.withColumn("_bucket", F.shiftright("_h", 64 - min(62, _stretch(groups.count(), 1))))
    parts = groups.groupBy("sid", "size", "_bucket").agg(F.sum("_p").alias("_n"))
    sizes = parts.groupBy("sid", "size").agg(F.sum("_n").alias("_n"))
    sizes = _before(sizes, ["sid"], [F.desc("size")], "_n", "_larger").drop("_n")
    parts = _before(parts, ["sid", "size"], ["_bucket"], "_n", "_above").drop("_n")
    rows = _before(groups, ["sid", "size", "_bucket"], ["_h", "_k1", "_k2"], "_p", "_in")
    rows = rows.join(parts, ["sid", "size", "_bucket"]).join(sizes, ["sid", "size"])
    rows = rows.withColumn("_from", F.col("_larger") + F.col("_above") + F.col("_in") + UNIT // 2)
    copies = F.col("_full") + F.expr(f"(_from + _p) div {UNIT} - _from div {UNIT}")
    return rows.select("sid", "_k1", "_k2", "_rows", copies.alias("_copies")).where("_copies > 0")


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, each in whole copies, ``most`` at most, so that every source has its target within half its largest document.

    Repeated rows share the copies of their document. Blank texts are left out. All columns stay as they are.
    """
    taken, sources = _mix(docs, weights, most, block)
    names = sources.select("sid", F.xxhash64(F.col("source").isNull(), "source").alias("_k3"))
    keys = ["_k1", "_k2", "_k3"]
    copies = stored(whole_copies(taken).join(names, "sid").select(*keys, "_rows", "_copies"), "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *row_key(), F.xxhash64(F.col("source").isNull(), "source").alias("_k3"))
    out = rows.join(copies.where("_rows = 1"), keys).select("_row", "_copies")
    repeated = copies.where("_rows > 1")
    if not repeated.isEmpty():
        more = rows.join(repeated, keys).withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("_row"))))
        more = more.withColumn("_copies", F.expr("_copies div _rows + if(_nth <= _copies % _rows, 1, 0)")).where("_copies > 0")
        out = out.union(more.select("_row", "_copies"))
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
