"""Near-duplicate detection by an LSH forest over MinHash signatures.

1. Every text becomes the set of its 64-bit word-shingle hashes, a 128-bit hash of that set and a MinHash signature.
   Rows with equal sets form a class; only the class's smallest doc_id goes on.
2. The forest has several orders of the signature, each a rotation of it. In each order a document has a region:
   those that share the first ``DEPTH`` values. Regions with one member are dropped by a count. The rest are
   range-partitioned by order and rotated signature, sorted and streamed: rows that follow each other within a region
   have the longest common prefix with one another, at whatever depth their part of the region needs, and are
   candidates. A group of close copies, however large, is thereby linked by a number of pairs in line with its size.
3. Each document's best candidate is confirmed on full sets and components are formed; then every other candidate
   that still joins two components is.
4. What sorted neighbours can't show is found by comparing a region's members, wherever a region still holds more than
   one component: those outside its largest component with one another and with those inside, in blocks of members
   that any task can take. Signatures and sizes pass over members without a likely partner; the others' full sets
   decide. So every pair that shares a region and whose components differ is looked at, whatever the region's size.

A link needs 100 * intersection >= percent * union of full sets. With 16 orders, a pair at the threshold of 0.85
shares no region with probability (1 - 0.85 ** 4) ** 16 = 7e-6. Lower thresholds use 32 overlapping orders. A pair that
shares one is passed over if fewer than percent less ``SLACK`` of its signature values agree: at the threshold with
probability 9e-6 for 85 % and 4e-5 for 80 %.

Defined results: a text with fewer words than the shingle takes is one shingle; null, empty or blank text has an
empty set and is linked with nothing. A null doc_id is linked with nothing and kept; its component is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, byte_table, materialize, mix, partitions, scope, span_hashes, text_chunks, word_spans
from .graph import connected_components, forest_roots

#: Words: runs of bytes other than space and 0x09-0x0D.
SPACED, LOW = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))

VALUES = 64
DEPTH = 4
#: Greatest bitmap of wanted documents: 16 MB.
BITMAP_BITS = 27
#: Most members, and bytes of their sets, in a block of a region (a larger set is a block alone).
BLOCK, BLOCK_BYTES = 256, 1 << 20
#: Most blocks outside a region's largest component that one part of its join takes.
PART_BLOCKS = 16
#: Shingles whose sets get their signatures at once, about.
SHINGLES = 1 << 17
#: Shingles that two blocks are compared on at once.
COLUMNS = 4096
#: Rows with full sets or signature blocks, or with blocks of sets, that Python gets at once.
SET_ROWS, BLOCK_ROWS = 64, 4
#: A candidate is confirmed if at least the threshold less this share of signature values agree: over four standard
#: deviations of the estimate.
SLACK = 0.21


def stride(percent: int) -> int:
    """By how many values each order is rotated against the one before: below 0.85 regions overlap, so that there are twice as many."""
    return DEPTH if percent >= 85 else DEPTH // 2


_SEEDS = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, VALUES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row."""
    with np.errstate(over="ignore"):
        for row, data, off in text_chunks(column):
            starts, ends, first = word_spans(data, off, SPACED)
            h = span_hashes(data, starts, ends, LOW)
            rolled = h[: max(0, len(h) - words + 1)].copy()
            for j in range(1, words):
                rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - words + 1 + j]
            rolled = mix(rolled)
            for k in range(len(off) - 1):
                a, b = first[k], first[k + 1]
                if b - a >= words:
                    yield row + k, np.unique(rolled[a : b - words + 1])
                elif b > a:
                    x = np.uint64(b - a)
                    for v in h[a:b]:
                        x = x * np.uint64(0x9E3779B97F4A7C15) + v
                    yield row + k, mix(np.array([x ^ np.uint64(0x5851F42D4C957F2D)]))
                else:
                    yield row + k, h[:0]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of VALUES 32-bit MinHash values for each non-empty set."""
    both, at = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), VALUES), np.uint32)
    with np.errstate(over="ignore"):
        for j, seed in enumerate(_SEEDS):
            out[:, j] = mix(np.minimum.reduceat((both ^ (seed >> np.uint64(1))) * seed, at)) >> np.uint64(32)
    return out


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc, n, s1, s2, sig) of every row; sig holds big-endian values and is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, sig, held = [], [], [], [], 0
            pending: list[np.ndarray] = []

            def flush(sig=sig, pending=pending):
                if full := [s for s in pending if len(s)]:
                    rows = iter(signatures(full).astype(">u4"))
                    sig += [next(rows).tobytes() if len(s) else None for s in pending]
                else:
                    sig += [None] * len(pending)
                pending.clear()

            with np.errstate(over="ignore"):
                for _, s in shingle_sets(batch["text"], words):
                    n.append(len(s))
                    s1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                    s2.append(int((mix(s) if len(s) else s).sum(dtype=np.uint64).view(np.int64)))
                    pending.append(s)
                    held += len(s)
                    if len(pending) >= 256 or held >= SHINGLES:
                        flush()
                        held = 0
            flush()
            yield pa.record_batch({"doc": batch["doc"], "n": pa.array(n, pa.int64()), "s1": pa.array(s1, pa.int64()), "s2": pa.array(s2, pa.int64()), "sig": pa.array(sig, pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc"), "text").mapInArrow(run, "doc long, n long, s1 long, s2 long, sig binary")


def _values(column: pa.Array) -> np.ndarray:
    """Signatures as rows of VALUES numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, VALUES)


def regions(reps: DataFrame, percent: int) -> DataFrame:
    """(doc, t, region) of the members of every region with two members or more; t is the order."""
    step = stride(percent)
    twice = F.concat("sig", "sig")
    prefix = [F.struct(F.lit(t).alias("t"), F.substring(twice, t * 4 * step + 1, 4 * DEPTH).alias("p")) for t in range(VALUES // step)]
    every = reps.select("doc", F.posexplode(F.transform(F.array(*prefix), lambda x: F.xxhash64(x["t"], x["p"]))).alias("t", "region"))
    shared = every.groupBy("region").agg(F.count("*").alias("size")).filter("size > 1").select("region")
    return materialize(every.join(shared, "region"), "forest")


def neighbours(shared: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, agree), a > b, of members that follow each other in a sorted order of their region and agree enough.

    Rows that a partition's end parts from the next one's start are no pair here; their region is compared later.
    """
    step, least = stride(percent), percent / 100 - SLACK
    rotated = F.concat(F.expr(f"substring(sig, t * {4 * step} + 1, {4 * VALUES})"), F.expr(f"substring(sig, 1, t * {4 * step})"))
    rows = shared.select("doc", "t").join(reps, "doc").select("t", rotated.alias("key"), "doc", "n")
    dealt = rows.repartitionByRange(partitions(reps.sparkSession), "t", "key", "doc").sortWithinPartitions("t", "key", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch["t"].to_numpy(), _values(batch["key"]), batch["doc"].to_numpy(), batch["n"].to_numpy()]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            t, key, doc, n = now
            rest = [x[-1:] for x in now]
            agree = (key[1:] == key[:-1]).sum(axis=1) / VALUES
            good = (t[1:] == t[:-1]) & (key[1:, :DEPTH] == key[:-1, :DEPTH]).all(axis=1) & (agree >= least) & (doc[1:] != doc[:-1])
            good &= 100 * np.minimum(n[1:], n[:-1]) >= percent * np.maximum(n[1:], n[:-1])
            a, b = doc[1:][good], doc[:-1][good]
            yield pa.record_batch({"a": pa.array(np.maximum(a, b)), "b": pa.array(np.minimum(a, b)), "agree": pa.array(agree[good])})

    found = dealt.mapInArrow(run, "a long, b long, agree double")
    return materialize(found.groupBy("a", "b").agg(F.max("agree").alias("agree")), "candidates")


def _bitmap(wanted: DataFrame, bits: int) -> np.ndarray:
    """A bit for each hash of a wanted document: at most 2 ** bits / 8 bytes come to the driver, whatever the input."""
    pos = F.pmod(F.xxhash64("doc"), F.lit(1 << bits)) + 1  # these functions count from 1
    rows = wanted.groupBy(F.bitmap_bucket_number(pos).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(pos)).alias("bits")).collect()
    out = np.zeros((1 << bits) // 8 + 4096, np.uint8)
    for r in rows:
        out[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(doc, set) of the documents in ``wanted`` (doc); a set is sorted little-endian 64-bit hashes.

    Texts of other documents are passed over where they are read, by a bitmap of hashes of bounded size; an exact
    semi-join of the few sets follows. With more wanted documents than such a bitmap can tell apart, texts are
    semi-joined instead.
    """
    wanted = materialize(wanted, "wanted")
    n = wanted.count()
    bits = max(16, min(BITMAP_BITS, (16 * n).bit_length()))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    few = 4 * n <= 1 << bits
    mask = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, bits)) if few else None
    if few:
        docs = docs.filter("doc is not null").withColumn("pos", F.pmod(F.xxhash64("doc"), F.lit(1 << bits)))
    else:
        docs = docs.join(wanted, "doc", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if mask is not None:
                pos = batch["pos"].to_numpy()
                batch = batch.filter(pa.array((mask.value[pos >> 3] >> (pos & 7).astype(np.uint8) & 1).astype(bool)))
            sets = [s.tobytes() for _, s in shingle_sets(batch["text"], words)] if batch.num_rows else []
            yield pa.record_batch({"doc": batch["doc"], "set": pa.array(sets, pa.binary())})

    sets = docs.mapInArrow(run, "doc long, set binary")
    return (sets.join(wanted, "doc", "left_semi") if few else sets).dropDuplicates(["doc", "set"])


def _linked(x: pa.Scalar, y: pa.Scalar, percent: int) -> bool:
    """Whether two full sets reach ``percent``."""
    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * same >= percent * (len(x) + len(y) - same)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, *keep: str) -> DataFrame:
    """The long columns ``keep`` of the pairs (a, b) whose full sets reach ``percent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array([_linked(x, y, percent) for x, y in zip(batch["x"], batch["y"], strict=True)], pa.bool_())
            yield batch.select(keep).filter(ok)

    wide = pairs.select("a", "b", *[c for c in keep if c not in ("a", "b")]).join(sets.select(F.col("doc").alias("a"), F.col("set").alias("x")), "a")
    wide = wide.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("y")), "b")
    return wide.select(*keep, "x", "y").mapInArrow(run, ", ".join(f"{c} long" for c in keep))


def with_components(rows: DataFrame, groups: DataFrame, doc: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the component of ``doc``, or itself where nothing is linked with it."""
    found = groups.select(F.col("node").alias(doc), F.col("component").alias(name))
    return rows.join(found, doc, "left").withColumn(name, F.coalesce(name, doc))


def apart(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc, t, region, own, rest) of regions that hold several components; rest: outside the largest of them."""
    named = with_components(shared, groups, "doc", "own")
    owns = named.groupBy("region", "own").agg(F.count("*").alias("c"))
    main = owns.groupBy("region").agg(F.max(F.struct("c", "own")).alias("x"), F.count("*").alias("owns")).filter("owns > 1").select("region", F.col("x.own").alias("main"))
    return named.join(main, "region").select("doc", "t", "region", "own", (F.col("own") != F.col("main")).alias("rest"))


def block_pairs(members: DataFrame, size: int, *columns: str) -> DataFrame:
    """(region, t, x, y, same): every two blocks of a region's members with one outside its largest component.

    ``members`` (doc, t, region, rest, bytes and ``columns``) are dealt to blocks by hash, of at most about BLOCK
    members and BLOCK_BYTES bytes; x and y are arrays of ``columns``. A region with many blocks is joined in parts:
    each takes up to PART_BLOCKS of those outside its largest component, and all blocks.
    """
    rest = F.col("rest")
    count = [F.greatest(F.ceil(F.count_if(c) / size), F.ceil(F.coalesce(F.sum(F.when(c, F.col("bytes"))), F.lit(0)) / BLOCK_BYTES)).cast("int") for c in (rest, ~rest)]
    sizes = members.groupBy("region", "t").agg(count[0].alias("outside"), count[1].alias("inside"))
    dealt = members.join(sizes, ["region", "t"]).withColumn("block", F.pmod(F.xxhash64("doc"), F.when(rest, F.col("outside")).otherwise(F.col("inside"))).cast("int"))
    grouped = dealt.groupBy("region", "t", "rest", "block").agg(F.first("outside").alias("outside"), F.collect_list(F.struct(*columns)).alias("members"))
    blocks = materialize(grouped.withColumn("parts", F.ceil(F.col("outside") / PART_BLOCKS).cast("int")), "blocks")
    left = blocks.filter("rest").select("region", "t", F.pmod("block", "parts").alias("part"), F.col("block").alias("i"), F.col("members").alias("x"))
    right = blocks.filter("parts > 0").select("region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rest", F.col("block").alias("j"), F.col("members").alias("y"))
    wide = left.join(right, ["region", "part"]).filter("not rest or i <= j")
    return wide.select("region", "t", "x", "y", (F.col("rest") & (F.col("i") == F.col("j"))).alias("same"))


def likely_members(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The ``members`` (doc, t, region, own, rest) that may be linked with one of another component in their region.

    A pair that shares a region of an earlier order is left to that one.
    """
    step = stride(percent)
    schema = "doc long, own long, rest boolean, region long, t int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, t, x, y, same in zip(batch["region"].to_pylist(), batch["t"].to_pylist(), batch["x"], batch["y"], batch["same"].to_pylist(), strict=True):
                (dx, ox, rx, nx, gx), (dy, oy, ry, ny, gy) = ([f.to_numpy(zero_copy_only=False) for f in z[:-1]] + [_values(z[-1])] for z in (x.values.flatten(), y.values.flatten()))
                if len(dx) * len(dy) <= 64:  # most regions have a few members
                    agree = (gx[:, None, :] == gy[None, :, :]).sum(axis=2)
                else:
                    agree = np.zeros((len(dx), len(dy)), np.uint8)
                    for k in range(VALUES):
                        agree += gx[:, k, None] == gy[None, :, k]
                good = (agree >= VALUES * (percent / 100 - SLACK)) & (ox[:, None] != oy[None, :])
                good &= 100 * np.minimum(nx[:, None], ny[None, :]) >= percent * np.maximum(nx[:, None], ny[None, :])
                if not good.any():
                    continue
                for k in range(t):
                    at = (k * step + np.arange(DEPTH)) % VALUES
                    hx, hy = (mix(mix(g[:, at[0]].astype(np.uint64) << np.uint64(32) | g[:, at[1]]) ^ (g[:, at[2]].astype(np.uint64) << np.uint64(32) | g[:, at[3]])) for g in (gx, gy))
                    good &= hx[:, None] != hy[None, :]
                i, j = np.flatnonzero(good.any(axis=1)), np.flatnonzero(good.any(axis=0))
                if same:
                    i, j = np.union1d(i, j), j[:0]
                found = [np.concatenate([a[i], b[j]]) for a, b in ((dx, dy), (ox, oy), (rx, ry))]
                yield pa.record_batch({**dict(zip(("doc", "own", "rest"), map(pa.array, found), strict=True)), "region": pa.array([region] * len(found[0]), pa.int64()), "t": pa.array([t] * len(found[0]), pa.int32())})

    rows = members.join(reps.select("doc", "n", "sig"), "doc").withColumn("bytes", F.lit(4 * VALUES))
    return block_pairs(rows, BLOCK, "doc", "own", "rest", "n", "sig").mapInArrow(run, schema).distinct()


def _shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set in ``x`` with every one in ``y``."""
    (hx, rx), (hy, ry) = ((np.concatenate(z), np.repeat(np.arange(len(z)), [len(s) for s in z])) for z in (x, y))
    both = np.intersect1d(hx, hy)
    out = np.zeros((len(x), len(y)), np.float32)
    for a in range(0, len(both), COLUMNS):
        part = both[a : a + COLUMNS]
        wide = []
        for h, r, n in ((hx, rx, len(x)), (hy, ry, len(y))):
            at = np.minimum(np.searchsorted(part, h), len(part) - 1)
            there = part[at] == h
            m = np.zeros((n, len(part)), np.float32)
            m[r[there], at[there]] = 1
            wide.append(m)
        out += wide[0] @ wide[1].T
    return out.astype(np.int64)


def _joining(x: pa.StructArray, y: pa.StructArray, percent: int) -> list[tuple[int, int]]:
    """Components ``own`` that links between members (own, set) of two blocks join."""
    (ox, sx), (oy, sy) = x.flatten(), y.flatten()
    ox, oy = ox.to_numpy(), oy.to_numpy()
    sx, sy = ([np.frombuffer(s, np.uint64) for s in z.to_pylist()] for z in (sx, sy))
    same = _shared_counts(sx, sy)
    nx, ny = np.array([len(s) for s in sx]), np.array([len(s) for s in sy])
    i, j = np.nonzero((100 * same >= percent * (nx[:, None] + ny[None, :] - same)) & (ox[:, None] != oy[None, :]))
    _, once = np.unique(np.column_stack([ox[i], oy[j]]), axis=0, return_index=True)
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while c in parent:
            c = parent[c]
        return c

    out = []
    for k in once:
        a, b = find(int(ox[i[k]])), find(int(oy[j[k]]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(ox[i[k]]), int(oy[j[k]])))
    return out


def region_links(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): components that a link joins among the ``likely`` members (doc, own, rest, region, t) of a region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"], strict=True):
                a, b = zip(*found, strict=True) if (found := _joining(x.values, y.values, percent)) else ((), ())
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = likely.join(sets, "doc").withColumn("bytes", F.octet_length("set"))
    return block_pairs(rows, BLOCK, "own", "set").mapInArrow(run, "a long, b long")


def grown(groups: DataFrame, joined: DataFrame) -> DataFrame:
    """``groups`` (node, component; a component's own id may lack) after the components in ``joined`` (a, b) are one.

    Only components that are joined go through the search for what hangs together; members follow by one join.
    """
    if joined.isEmpty():
        return groups
    merged = connected_components(joined)
    now = merged.select(F.col("node").alias("component"), F.col("component").alias("now"))
    moved = groups.filter("node <> component").join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return materialize(moved.union(merged.filter("node <> component").select("node", "component")), "grown")


def link_components(docs: DataFrame, words: int, percent: int, marks: DataFrame) -> DataFrame:
    """(node, component) of the class representatives in ``marks`` that are linked with a smaller one."""
    spark = docs.sparkSession
    reps = materialize(marks.filter("n > 0 and doc is not null").groupBy("s1", "s2").agg(F.min(F.struct("doc", "n", "sig")).alias("x")).select("x.doc", "x.n", "x.sig"), "reps")
    shared = regions(reps, percent)
    found = neighbours(shared, reps, percent)
    with arrow_rows(spark, SET_ROWS):
        sets = materialize(full_sets(docs, found.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), words), "sets")
        best = found.groupBy("a").agg(F.max(F.struct("agree", (-F.col("b")).alias("b"))).alias("x")).select("a", (-F.col("x.b")).alias("b"))
        # one smaller partner each, so these links are a forest
        groups = forest_roots(confirmed(best, sets, percent, "a", "b"))
        other = with_components(with_components(found.join(best, ["a", "b"], "left_anti"), groups, "a", "ca"), groups, "b", "cb").filter("ca <> cb")
        linked = confirmed(other, sets, percent, "ca", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        groups = grown(groups, materialize(linked, "links"))
    with arrow_rows(spark, SET_ROWS):
        likely = materialize(likely_members(apart(shared, groups), reps, percent), "likely")
    if likely.isEmpty():
        return groups
    with arrow_rows(spark, SET_ROWS):
        sets = materialize(full_sets(docs, likely.select("doc").distinct(), words), "sets")
    with arrow_rows(spark, BLOCK_ROWS):
        return grown(groups, materialize(region_links(likely, sets, percent), "links"))


def near_dedup(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    marks = materialize(sketches(docs, words), "sketches")
    with scope():
        groups = materialize(link_components(docs, words, percent, marks), "groups", result=True)
    classes = marks.filter("n > 0 and doc is not null").groupBy("s1", "s2").agg(F.min("doc").alias("rep"))
    classes = classes.join(groups, classes["rep"] == groups["node"], "left").select("s1", "s2", F.coalesce("component", "rep").alias("least"))
    out = marks.select("doc", "n", "s1", "s2").join(classes, ["s1", "s2"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.col("least")).otherwise(F.col("doc"))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """``docs`` without the rows whose document is not the smallest of its component."""
    with scope():
        gone = materialize(near_dedup(docs, words, percent).filter("not kept").select(F.col("doc_id").alias("gone")).distinct(), "not-kept", result=True)
    place = [f"c{k}" for k in range(len(docs.columns))]
    doc_id = place[docs.columns.index("doc_id")]
    return docs.toDF(*place).join(gone, F.col(doc_id) == F.col("gone"), "left_anti").toDF(*docs.columns)
