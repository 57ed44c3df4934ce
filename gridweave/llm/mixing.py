"""Mix sources to target weights: equal-word blocks of shuffled documents, joined to a low-discrepancy schedule of sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.llm.common import WORD, fresh, word_count
from gridweave.sources.scratch import written

#: A prime and that prime over the golden ratio: multiples of the second modulo the first, over the first, fill an interval evenly.
PRIME, STEP = 2_147_483_647, 1_327_217_884
#: Rows or slots that one window group holds on average.
GROUP = 2_000


@dataclass(frozen=True)
class Mix:
    """Parameters: weights repeated over the sources in order, total over the sum of sizes, most passes over a source, words in a block, seed."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    passes: float = 2.0
    block: int = 128
    seed: int = 42


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source (columns ``source``, ``rows``, ``source_size``) with ``weight``, ``target`` and its rank ``s``.

    The total is shared by weight; a source stops at ``passes`` times its size and the excess goes to the others by weight, until
    none is above. That settles at one price per unit of weight: sources fill up in order of size over weight, and the price
    is found where the rest no longer overflow. All windows here run over the table of sources only.
    """
    n = len(mix.weights)
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    table = (
        sizes.groupBy("source")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
        .withColumn("s", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), F.pmod("s", F.lit(n)) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(mix.passes))
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    price = (F.sum("source_size").over(everything) * F.lit(mix.share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    priced = table.withColumn("price", price).withColumn("open", F.col("price") * F.col("weight") <= F.col("cap"))
    settled = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("s"), F.col("price")))).over(everything)
    return priced.withColumn("settled", settled["price"]).withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("settled") * F.col("weight"), F.col("cap")))).select("source", "s", "rows", "source_size", "weight", "target")


def running(df: DataFrame, part: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before, within ``part``, in order of ``bucket`` and then ``order``.

    Sums of buckets are added up first, over the small table of buckets; the rows of a bucket are then summed on their own. So no window
    group holds more than a bucket, however large a part is.
    """
    sums = df.groupBy(*part, bucket).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    own = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(sums, [*part, bucket]).withColumn(name, F.col("_ahead") + F.coalesce(F.sum(value).over(own), F.lit(0))).drop("_ahead")


def _slots(mix: Mix) -> Column:
    """Slots that a source wants: its blocks, of which the last is short, times its target over its size."""
    return F.ceil(F.col("source_size") / F.lit(float(mix.block))) * F.col("target") / F.col("source_size")


def counted(rows: DataFrame, n: str, name: str) -> DataFrame:
    """Each row of ``rows`` ``n`` times, numbered from 0 in ``name``: first in runs, which are dealt out, and then one by one."""
    runs = rows.where(F.col(n) > 0).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / GROUP)))).repartition("s", "run")
    first = F.col("run") * GROUP
    return runs.withColumn(name, F.explode(F.sequence(first, F.least(first + GROUP, F.col(n)) - 1)))


def schedule(targets: DataFrame, slots: int, mix: Mix) -> DataFrame:
    """Columns ``k`` (position), ``s`` (source) and ``r`` (rank among the source's positions, from 0) for ``slots`` positions.

    Position ``k`` has the point ``frac((k + 1) / golden ratio)``, in whole numbers modulo a prime; the source is that whose stretch of the
    cumulative slots wanted holds the point. In every run of positions each source then has its share to within a few.
    """
    wanted = targets.where("target > 0")
    so_far = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stretch = wanted.select("s", F.sum(_slots(mix)).over(so_far).alias("e")).withColumn("to", F.col("e") / F.max("e").over(every))
    stretch = stretch.withColumn("from", F.lag("to", 1, 0.0).over(Window.orderBy("s"))).withColumn("n", F.count(F.lit(1)).over(every))
    # the unit interval in as many cells as there are sources: points and stretches meet by cell, so any number of sources will do
    cell = lambda x: F.least(F.floor(x * F.col("n")), F.col("n") - 1)
    stretches = written(stretch.withColumn("cell", F.explode(F.sequence(cell(F.col("from")), cell(F.col("to"))))).select("s", "from", "to", "cell"), "stretches")
    n = wanted.count()
    point = F.pmod(F.pmod(F.col("k") + 1, F.lit(PRIME)) * STEP, F.lit(PRIME)) / F.lit(float(PRIME))
    points = targets.sparkSession.range(slots).withColumnRenamed("id", "k").withColumn("p", point).withColumn("n", F.lit(n)).withColumn("cell", cell(F.col("p"))).drop("n")
    located = points.join(stretches, "cell").where((F.col("from") <= F.col("p")) & (F.col("p") < F.col("to"))).select("k", "s", F.floor(F.col("k") / GROUP).alias("run"))
    return running(located, ["s"], "run", [F.col("k")], F.lit(1), "r").select("k", "s", F.col("r").cast("long"))


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size`` (words), ``source_size``, ``target`` (its source's) and ``taken`` (words the mix takes).

    The documents of a source stand in an order shuffled by a seeded hash of id and text and are cut into blocks of ``mix.block`` words, which are shuffled
    once more. The schedule gives each source its slots; the slot with rank ``r`` takes the block that comes ``r``-th, starting
    anew after each pass. A document takes what the taken blocks hold of it, once per time taken; no block is taken more than
    ``mix.passes`` times. Equal input gives equal results. Null and empty texts have size 0 and take 0; a null source is one
    source, ordered last; repeated rows are rows of their own; no rows give no rows; other columns are ignored.
    """
    sizes = written(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(mix.seed), F.col(id_col), F.col(text_col)).alias("h")),
        "sizes",
    )
    targets = written(source_targets(sizes, mix), "targets")
    block = F.lit(mix.block)
    sources = targets.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(float(mix.block)))).withColumn("buckets", F.ceil(F.col("rows") / F.lit(float(GROUP))))
    total = int((targets.where("target > 0").agg(F.sum(_slots(mix)).alias("t")).first()["t"] or 0.0) + 0.5)

    # where each document lies among the words of its source; the buckets follow the order of the hash
    high = F.shiftrightunsigned("h", 33)
    known = sizes.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    own = known.where("size > 0").withColumn("bucket", F.floor(high * F.col("buckets") / F.lit(float(1 << 31))))
    placed = running(own, ["s"], "bucket", [high, F.col("h"), F.col("id"), F.col("size")], F.col("size"), "start")

    # times that each block is taken: the slots whose rank falls on its position
    ranked = schedule(targets, total, mix).join(sources.select("s", "blocks"), "s") if total else None
    numbered = counted(sources.select("s", "blocks"), "blocks", "b").withColumn("h", F.xxhash64(F.lit(mix.seed), "s", "b")).withColumn("bucket", F.floor(F.shiftrightunsigned("h", 33) * F.ceil(F.col("blocks") / F.lit(float(GROUP))) / F.lit(float(1 << 31))))
    shuffled = running(numbered, ["s"], "bucket", [F.shiftrightunsigned("h", 33), F.col("h"), F.col("b")], F.lit(1), "pos").select("s", "b", F.col("pos").cast("long"))
    if ranked is None:
        times = shuffled.select("s", "b", F.lit(0).cast("long").alias("times"))
    else:
        taken = ranked.where(F.col("r") < F.floor(F.col("blocks") * F.lit(mix.passes))).groupBy("s", (F.col("r") % F.col("blocks")).alias("pos")).agg(F.count(F.lit(1)).alias("times"))
        times = shuffled.join(taken, ["s", "pos"]).select("s", "b", "times")

    stop = F.col("start") + F.col("size")
    parts = placed.withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((stop - 1) / block))))
    overlap = F.least(stop, (F.col("b") + 1) * block) - F.greatest(F.col("start"), F.col("b") * block)
    some = (
        parts.withColumn("overlap", overlap)
        .join(times, ["s", "b"], "left")
        .groupBy("id", "s", "start", "size", "source", "source_size", "target")
        .agg(F.sum(F.col("overlap") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
    )
    columns = [F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", F.col("target").cast("double")]
    return some.select(*columns, "taken").unionByName(known.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken")))


def take_mix(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", drawn: bool = False) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as ``taken`` over its size, to the nearest whole number.

    The nearest number is the same for most long rows of a source, so its words may miss its target by half its size. Where
    ``drawn`` is set, a row is taken once more than the whole part of its ratio if a seeded hash of its id and text lies below the fraction, so
    that a source has its target's words on average. Rows that share an id (or have none) share their ratio. Rows without words
    (null and empty texts too) are not taken; a null source is one source; very long texts are taken whole; equal rows are taken alike;
    no rows give no rows; the columns of ``docs`` may have any names.
    """
    key, times, copy = (fresh(docs, name) for name in ("id", "times", "copy"))
    ratio = F.try_divide(F.sum("taken"), F.sum("size"))
    ratios = mixed(docs, mix, id_col, text_col, source_col).groupBy(F.col(id_col).alias(key)).agg(ratio.alias(times)).where(F.col(times) > 0)
    chosen = docs.where(F.col(text_col).rlike(WORD)).join(ratios, F.col(id_col).eqNullSafe(F.col(key)))
    # another seed than that of the order in which documents are dealt
    point = F.shiftrightunsigned(F.xxhash64(F.lit(mix.seed + 1), id_col, text_col), 11) / F.lit(float(1 << 53))
    whole = F.floor(F.col(times)) + (point < F.col(times) - F.floor(times)).cast("long") if drawn else F.floor(F.col(times) + 0.5)
    return chosen.withColumn(times, whole).where(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)
