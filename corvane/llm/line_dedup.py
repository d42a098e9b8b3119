"""Line deduplication by range partitions, a secondary sort and keep bitmaps.

Every long enough line becomes a row (key hash, document, position). Rows are range-partitioned on the whole row
and sorted, documents falling: a key that very many documents hold is thereby cut over as many partitions as its
rows need. Partitions are streamed once; a key wholly inside one is decided there, and the at most two keys a
partition shares with its neighbours are decided from a table of at most two rows a partition, the only thing that
is broadcast. What comes out are positions to drop, gathered to one compressed bitmap a document, which a join then puts
beside the document's text.

Rule: keys of at least ``least_chars`` code points that stand in at least ``least_docs`` documents lose all their
lines except in the largest doc_id holding them.

Defined results: null or empty text is one empty line. Rows with a null doc_id keep every line and don't count as
documents. Rows that repeat a doc_id are one document for counting; each row keeps and loses its own lines.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, materialize, partitions

#: What is stripped at both ends of a line, and the lower-casing of a key.
STRIP = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}

LINE_SCHEMA = "h1 long, h2 long, doc long, pos int, row long"
DROP_SCHEMA = "doc long, row long, pos int"


def line_rows(docs: DataFrame, least_chars: int) -> DataFrame:
    """(h1, h2, doc, pos, row) of every line whose key has ``least_chars`` code points; ``row`` is the text's CRC."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, doc, pos, row = [], [], [], []
            for d, t in zip(batch["doc"].to_pylist(), (x.as_py() for x in batch["text"]), strict=True):
                if d is None or not t or len(t) < least_chars:
                    continue
                before = len(keys)
                for k, line in enumerate(t.split("\n")):
                    if len(line) >= least_chars and len(key := line.strip(STRIP)) >= least_chars:
                        keys.append(xxhash.xxh3_128_digest(key.translate(LOWER) if not key.islower() else key))
                        pos.append(k)
                n = len(keys) - before
                if n:
                    doc += [d] * n
                    row += [zlib.crc32(t.encode())] * n
            h = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
            yield pa.record_batch({
                "h1": pa.array(np.ascontiguousarray(h[:, 0])),
                "h2": pa.array(np.ascontiguousarray(h[:, 1])),
                "doc": pa.array(doc, pa.int64()),
                "pos": pa.array(pos, pa.int32()),
                "row": pa.array(row, pa.int64()),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc"), "text").mapInArrow(run, LINE_SCHEMA)


def _decide(h: np.ndarray, doc: np.ndarray, least_docs: int, shared: dict) -> np.ndarray:
    """Mask of the rows to drop among sorted rows of whole keys, or of keys in ``shared``."""
    n = len(doc)
    new_key = np.ones(n, bool)
    new_key[1:] = (h[1:] != h[:-1]).any(axis=1)
    new_doc = new_key.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_key)
    group = np.cumsum(new_key) - 1
    n_docs, largest = np.add.reduceat(new_doc.astype(np.int64), at), doc[at]
    for g in {0, len(at) - 1}:
        if known := shared.get((int(h[at[g], 0]), int(h[at[g], 1]))):
            n_docs[g], largest[g] = known
    return (n_docs[group] >= least_docs) & (doc != largest[group])


def dropped_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """(doc, row, pos) of every line to drop."""
    spark = docs.sparkSession
    lines = materialize(line_rows(docs, least_chars), "lines")  # sampled and then dealt: texts are split once
    dealt = lines.repartitionByRange(partitions(spark), "h1", "h2", F.col("doc").desc(), "pos")
    dealt = checkpointed(dealt.sortWithinPartitions("h1", "h2", F.col("doc").desc(), "pos"))
    key = F.struct("h1", "h2")
    part = dealt.withColumn("part", F.spark_partition_id())
    ends = part.groupBy("part").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    ends = ends.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").count().filter("count > 1").select("k.h1", "k.h2")
    # a key at two partitions' ends; at most one row a partition
    cut = dealt.join(F.broadcast(ends), ["h1", "h2"]).groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    cut = cut.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("largest"))
    shared = {(r.h1, r.h2): (r.n, r.largest) for r in cut.collect()}
    known = spark.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = known.value
        rest: list[tuple] = []  # batches that hold only rows of the key that the last batch ended in

        def out(cols: list[np.ndarray]) -> pa.RecordBatch:
            h, doc, pos, row = cols
            drop = _decide(h, doc, least_docs, shared)
            return pa.record_batch({"doc": pa.array(doc[drop]), "row": pa.array(row[drop]), "pos": pa.array(pos[drop])})

        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, doc, pos, row = (batch[c].to_numpy() for c in ("h1", "h2", "doc", "pos", "row"))
            h = np.column_stack([h1, h2])
            change = np.flatnonzero((h[1:] != h[:-1]).any(axis=1)) + 1
            tail = int(change[-1]) if len(change) else 0
            if rest and not (rest[-1][0][-1] == h[0]).all():
                yield out([np.concatenate(x) for x in zip(*rest, strict=True)])
                rest = []
            if (int(h[-1, 0]), int(h[-1, 1])) in shared:
                tail = len(doc)  # its numbers are known: nothing has to wait for its end
            if tail:
                rest.append((h[:tail], doc[:tail], pos[:tail], row[:tail]))
                yield out([np.concatenate(x) for x in zip(*rest, strict=True)])
                rest = []
            if tail < len(doc):
                rest.append((h[tail:], doc[tail:], pos[tail:], row[tail:]))
        if rest:
            yield out([np.concatenate(x) for x in zip(*rest, strict=True)])

    return dealt.mapInArrow(run, DROP_SCHEMA)


def keep_bitmaps(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """(doc, row, bitmap) of the documents that lose lines: a deflated little-endian bit a line, 1 to keep it.

    Lines beyond the bitmap's end stay. ``row`` is crc32(text).
    """
    gathered = dropped_lines(docs, least_chars, least_docs).groupBy("doc", "row").agg(F.collect_list("pos").alias("pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for p in batch["pos"]:
                p = np.asarray(p.values)
                bits = np.ones(-(-(int(p.max()) + 1) // 8) * 8, np.uint8)
                bits[p] = 0
                maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            yield pa.record_batch({"doc": batch["doc"], "row": batch["row"], "bitmap": pa.array(maps, pa.binary())})

    return gathered.mapInArrow(run, "doc long, row long, bitmap binary")


def kept_lines(text: str, bitmap: bytes | None) -> tuple[str, int, int]:
    """The text without its dropped lines, its number of lines, and the number dropped."""
    if bitmap is None:
        return text, text.count("\n") + 1, 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    lines = text.split("\n")
    drop = set(np.flatnonzero(bits[: len(lines)] == 0).tolist())
    return "\n".join(x for k, x in enumerate(lines) if k not in drop), len(lines), len(drop)


def _with_bitmaps(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """Columns of ``docs`` as c0, c1, ... with ``bitmap`` after them."""
    maps = keep_bitmaps(docs.select("doc_id", "text"), least_chars, least_docs)
    place = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    left = docs.toDF(*place.values()).withColumn("_row", F.crc32(F.col(place["text"]).cast("binary")))
    cond = (left[place["doc_id"]].cast("long") == maps["doc"]) & (left["_row"] == maps["row"])
    return left.join(maps, cond, "left").select(*place.values(), "bitmap")


def line_dedup(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what is kept, for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (x.as_py() or "" for x in batch["c1"])
            got = [kept_lines(t, b.as_py()) for t, b in zip(texts, batch["bitmap"], strict=True)]
            yield pa.record_batch({
                "doc_id": batch["c0"],
                "n_lines": pa.array([x[1] for x in got], pa.int64()),
                "n_dropped": pa.array([x[2] for x in got], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x[0].encode()).hexdigest() for x in got], pa.string()),
            })

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_bitmaps(docs, least_chars, least_docs).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """``docs`` with repeated lines taken out of text, and n_chars, if there, set to what is left."""
    names = docs.columns
    text = f"c{names.index('text')}"
    length = f"c{names.index('n_chars')}" if "n_chars" in names else None
    wide = _with_bitmaps(docs, least_chars, least_docs)
    schema = wide.drop("bitmap").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch[c] for c in batch.schema.names if c != "bitmap"}
            if batch["bitmap"].null_count < batch.num_rows:
                texts = [t if b is None else kept_lines(t, b)[0] for t, b in zip(batch[text].to_pylist(), batch["bitmap"].to_pylist(), strict=True)]
                cols[text] = pa.array(texts, batch[text].type)
                if length:
                    cols[length] = pa.array([n if b is None else len(t) for n, t, b in zip(batch[length].to_pylist(), texts, batch["bitmap"].to_pylist(), strict=True)], batch[length].type)
            yield pa.record_batch(cols)

    return wide.mapInArrow(run, schema).toDF(*names)
