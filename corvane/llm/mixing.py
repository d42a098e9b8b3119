"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Each source weighs by its place in code-point order. Targets share the total size by weight; a source whose target
exceeds ``most`` times its size is clamped there and the excess is shared by weight among the others, until none
exceeds. A source then repeats whole ``floor(target / size)`` times, and a seeded hash order of its documents takes
part once more until the rest of the target is filled: documents whose hash is under the source's cut are taken
once more, and of those that follow within the cut's bucket the one whose size is nearest to the words still missing,
if that is nearer than none. Documents are taken whole, so a target is met to within half of such a document.

The cut is found without ordering a source in one place: sizes are summed by hash bucket, one for
about ``BUCKET_ROWS`` rows, and only the bucket that holds the cut is ordered. The plan has one row a source; it is
broadcast only up to ``BROADCAST_ROWS`` rows.

Defined results: null text has size 0; a null source is one source, last in order; a source without words has
target 0. Rows that tie (equal doc_id and text) are taken together. A null doc_id takes part as any other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, materialize, scope

WEIGHTS = (5, 2, 1)
MOST = 3
BROADCAST_ROWS = 20_000
#: Rows of all sources that share a hash bucket, about.
BUCKET_ROWS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def _size() -> Column:
    return F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order of ``key``, nulls last, by range partitions and their counts."""
    dealt = checkpointed(rows.orderBy(F.col(key).asc_nulls_last()))
    dealt = dealt.select("*", F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % (1 << 33)).alias("_nth"))
    counts = dealt.groupBy("_part").count().orderBy("_part").collect()
    before, total = [], 0
    for r in counts:
        before.append((r["_part"], total))
        total += r["count"]
    if not before:
        return dealt.withColumn("rank", F.lit(0).cast("long")).drop("_part", "_nth")
    starts = F.create_map(*[F.lit(x) for pair in before for x in pair])
    return dealt.withColumn("rank", (F.col("_nth") + F.try_element_at(starts, F.col("_part"))).cast("long")).drop("_part", "_nth")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) of every source in ``sizes`` (source, size)."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(ranked(total, "source").select("source", "source_size", by_place.alias("weight")), "sources")
    level, before = 0.0, None
    cap = most * F.col("source_size")
    while level != before:
        before = level
        full = cap < F.col("weight") * level
        r = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, cap)).alias("capped"), F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        level = max(level, ((r["all"] or 0) - (r["capped"] or 0)) / r["w"]) if r["w"] else level
    return sources.withColumn("target", F.least(F.col("weight") * level, cap.cast("double")))


def plan(sizes: DataFrame, aims: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target, whole, cut, extra): repetitions of all; hashes under ``cut`` and ``extra`` are taken once more."""
    n = sizes.count()
    bits = max(1, min(24, (n // BUCKET_ROWS).bit_length()))
    bucket = F.shiftright("h", 64 - bits)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    aims = aims.withColumn("whole", whole).withColumn("rest", F.round(F.col("target")).cast("long") - F.col("whole") * F.col("source_size"))
    aims = materialize(aims.withColumn("rest", F.when(F.col("whole") >= most, 0).otherwise(F.greatest("rest", F.lit(0)))), "aims")
    sums = sizes.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("s"))
    up_to = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("s").over(up_to)).withColumn("before", F.col("upto") - F.col("s"))
    place = sums.withColumnRenamed("source", "_s").join(aims.select("source", "rest"), F.col("_s").eqNullSafe(F.col("source")))
    place = materialize(place.filter("before <= rest and rest < upto").select(F.col("_s").alias("b_source"), F.col("bucket").alias("b"), F.col("rest") - F.col("before")), "buckets").toDF("b_source", "b", "left")
    few = place.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    inside = sizes.join(F.broadcast(place) if few else place, sizes["source"].eqNullSafe(F.col("b_source")) & (bucket == F.col("b")))
    ties = inside.groupBy("source", "h").agg(F.sum("size").alias("s"), F.first("left").alias("left"))
    ties = ties.withColumn("upto", F.sum("s").over(Window.partitionBy("source").orderBy("h"))).withColumn("gap", F.col("left") - F.col("upto") + F.col("s"))
    later = ties.filter("left < upto")
    cut = later.groupBy("source").agg(F.min(F.struct("h", "gap")).alias("x")).select(F.col("source").alias("c_source"), F.col("x.h").alias("cut"), F.col("x.gap").alias("missing"))
    late = later.select("source", "h", "s").join(cut, F.col("source").eqNullSafe(F.col("c_source")))
    off = F.abs(F.col("s") - F.col("missing"))
    extra = F.when(F.min(off) < F.first("missing"), F.min(F.struct(off.alias("off"), "h"))["h"])
    ends = late.groupBy("c_source").agg(F.first("cut").alias("cut"), extra.alias("extra"))
    out = aims.join(ends, aims["source"].eqNullSafe(ends["c_source"]), "left")
    # no cut: what is left is the source's every word (none is left over) or nothing
    return materialize(out.select("source", "source_size", "target", "whole", "cut", "extra"), "mix-plan", result=True)


def _planned(docs: DataFrame, made: DataFrame) -> DataFrame:
    made = made.withColumnRenamed("source", "_source")
    few = made.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(made) if few else made, docs["source"].eqNullSafe(F.col("_source")), "left")


def _more() -> Column:
    """Whether a row is taken once more."""
    return F.coalesce((F.col("h") < F.col("cut")) | (F.col("h") == F.col("extra")), F.lit(False))


def _plan_of(docs: DataFrame, weights, most: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, h) of every row, and the plan."""
    with scope():
        sizes = docs.select("doc_id", "source", _size().alias("size"), _hash(seed).alias("h"))
        sizes = materialize(sizes, "sizes", result=True)
        return sizes, plan(sizes, targets(sizes, weights, most), most)


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 8) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs``."""
    sizes, made = _plan_of(docs, weights, most, seed)
    taken = (F.col("whole") + _more().cast("long")) * F.col("size")
    return _planned(sizes, made).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 8) -> DataFrame:
    """``docs`` as mixed: each row as often as it is taken."""
    _, made = _plan_of(docs, weights, most, seed)
    place = [f"c{k}" for k in range(len(docs.columns))]
    wide = docs.select(*[F.col(c).alias(x) for c, x in zip(docs.columns, place, strict=True)], "source", _hash(seed).alias("h"))
    copies = F.array_repeat(F.lit(0), (F.col("whole") + _more().cast("long")).cast("int"))
    return _planned(wide, made).select(*place, F.explode(copies)).select(*place).toDF(*docs.columns)
