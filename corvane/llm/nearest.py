"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors are indexed once, with the smallest ids that hold them. Distinct vectors are dealt to shards by
hash; each shard builds its graph as flat int32 neighbour arrays, one array a level, and stores it as one binary
row of bounded size. A search task gets a shard's graph once and streams queries past it, batch after batch, so
neither graphs nor memory multiply with the number of queries; a shard has as many tasks as keep the cluster busy.
The shards' nearest are merged by a window per query vector.

The largest inner product becomes the least Euclidean distance by one more component, sqrt(max norm ** 2 - norm
** 2), on indexed vectors and 0 on queries. Scores are inner products of the original vectors in double precision.

Searches advance a batch of queries one expansion at a time, so that numpy handles them together; points are
inserted in batches that grow with the graph.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with
a null id. Vectors of different lengths never meet. Ties go to the smaller id. A repeated id is one candidate for
each distinct vector it has. No vectors give no rows.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, materialize, partitions

LINKS = 16
EF_BUILD = 80
EF_SEARCH = 160
#: Rows from which there are more shards, up to MANY; beyond, their number grows with the bytes that a shard may hold.
SHARD_ROWS = 8192
MANY = 64
SHARD_BYTES = 128 << 20
#: Bytes of a node besides its vector: links and levels.
NODE_BYTES = 8 * LINKS + 64
#: Queries that Python gets at once.
QUERY_ROWS = 2048


class Graph:
    """Vectors with flat neighbour arrays: ``links[level]`` has a row of neighbours, -1 where there is none, for every node."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], levels: np.ndarray, entry: int):
        self.vectors, self.links, self.levels, self.entry = vectors, links, levels, entry
        self.squares = np.einsum("ij,ij->i", vectors, vectors)

    def save(self) -> bytes:
        out = io.BytesIO()
        upper = [x[self.levels >= k + 1] for k, x in enumerate(self.links[1:])]
        np.savez(out, vectors=self.vectors, levels=self.levels, entry=self.entry, base=self.links[0], **{f"u{k}": x for k, x in enumerate(upper)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        x = np.load(io.BytesIO(data))
        levels, links = x["levels"], [x["base"]]
        for k in range(sum(n.startswith("u") for n in x.files)):
            whole = np.full((len(levels), LINKS), -1, np.int32)
            whole[levels >= k + 1] = x[f"u{k}"]
            links.append(whole)
        return cls(x["vectors"], links, levels, int(x["entry"]))

    def distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distance, less the query's own square, of each query to its nodes; infinite where a node is -1."""
        d = self.squares[nodes] - 2 * np.einsum("qd,qmd->qm", q, self.vectors[nodes])
        d[nodes < 0] = np.inf
        return d

    def search_level(self, q: np.ndarray, found: np.ndarray, dist: np.ndarray, level: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes of a level to each query, nearest first, from starting nodes."""
        n, links = len(q), self.links[level]
        ids, ds = np.full((n, ef), -1, np.int64), np.full((n, ef), np.inf, np.float32)
        k = min(ef, found.shape[1])
        ids[:, :k], ds[:, :k] = found[:, :k], dist[:, :k]
        done = np.zeros((n, ef), bool)
        seen = np.zeros((n, len(self.levels)), bool)
        rows = np.repeat(np.arange(n), k)
        ok = found[:, :k].ravel() >= 0
        seen[rows[ok], found[:, :k].ravel()[ok]] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(done[live] | (ids[live] < 0), np.inf, ds[live])
            at = np.argmin(waiting, axis=1)
            go = np.isfinite(waiting[np.arange(len(live)), at])
            live, at = live[go], at[go]
            if not len(live):
                break
            done[live, at] = True
            near = links[ids[live, at]].astype(np.int64)
            near[seen[live[:, None], near]] = -1
            r, c = np.nonzero(near >= 0)
            seen[live[r], near[r, c]] = True
            d = self.distances(q[live], near).astype(np.float32)
            all_ids, all_d = np.concatenate([ids[live], near], axis=1), np.concatenate([ds[live], d], axis=1)
            all_done = np.concatenate([done[live], np.zeros_like(near, bool)], axis=1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
            ids[live], ds[live] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_d, order, 1)
            done[live] = np.take_along_axis(all_done, order, 1)
        ids[~np.isfinite(ds)] = -1
        return ids, ds

    def descend(self, q: np.ndarray, top: int, bottom: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedy search from the entry through levels ``top`` to ``bottom`` + 1."""
        found = np.full((len(q), 1), self.entry, np.int64)
        dist = self.distances(q, found).astype(np.float32)
        for level in range(top, bottom, -1):
            found, dist = self.search_level(q, found, dist, level, 1)
        return found, dist

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        found, dist = self.descend(q, len(self.links) - 1, 0)
        return self.search_level(q, found, dist, 0, ef)[0]


def _diverse(vectors: np.ndarray, squares: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, nearest first, those nearer to the point than to any chosen before; then the nearest of the rest."""
    if len(ids) <= most // 2:
        return ids
    x, s = vectors[ids], squares[ids]
    between = s[:, None] + s[None, :] - 2 * (x @ x.T)
    ok = np.ones(len(ids), bool)
    chosen: list[int] = []
    for k in range(len(ids)):
        if ok[k]:
            chosen.append(k)
            if len(chosen) == most:
                break
            ok &= between[k] > dist
    if len(chosen) < most:
        picked = set(chosen)
        chosen += [k for k in range(len(ids)) if k not in picked][: most - len(chosen)]
    return ids[chosen]


def build(vectors: np.ndarray, seed: int = 4) -> Graph:
    """A graph over float32 vectors."""
    n = len(vectors)
    rng = np.random.Generator(np.random.PCG64(seed))
    levels = np.minimum(np.floor(-np.log(rng.random(n)) / math.log(LINKS)).astype(np.int64), 8)
    top = int(np.argmax(levels))
    # the tallest node first: it is the entry from the start
    links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k in range(int(levels[top]) + 1)]
    g = Graph(vectors, links, levels, top)
    sq, todo, inserted = g.squares, np.delete(np.arange(n), top), 1
    while len(todo):
        batch, todo = np.split(todo, [min(len(todo), max(1, min(256, inserted // 8)))])
        searched = []  # on every level before any link is made: a new node leads nowhere on lower levels yet
        for level in range(int(levels[batch].max()), -1, -1):
            rows = batch[levels[batch] >= level]
            q = vectors[rows]
            ids, ds = g.search_level(q, *g.descend(q, len(links) - 1, level), level, EF_BUILD)
            searched.append((level, rows, ids, ds + sq[rows][:, None]))
        for level, rows, ids, ds in searched:
            most = links[level].shape[1]
            for p, i, d in zip(rows, ids, ds, strict=True):
                i, d = i[i >= 0], d[: (i >= 0).sum()]
                near = _diverse(vectors, sq, i, d, LINKS)
                links[level][p, : len(near)] = near
                for a in near:
                    row = links[level][a]
                    free = np.flatnonzero(row < 0)
                    if len(free):
                        row[free[0]] = p
                        continue
                    them = np.append(row, p).astype(np.int64)
                    d2 = sq[a] + sq[them] - 2 * (vectors[them] @ vectors[a])
                    order = np.argsort(d2, kind="stable")
                    kept = _diverse(vectors, sq, them[order], d2[order], most)
                    row[:] = -1
                    row[: len(kept)] = kept
        inserted += len(batch)
    return g


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    df = df.select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("v"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    df = df.filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, odd) & F.exists(v, lambda x: x != 0))
    return df


def nearest(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", ef: int = EF_SEARCH) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for every row of ``df`` for which ``is_query(id column)``."""
    rows = _valid(df, id_col, vector_col)
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("nth") <= k + 1)
    same = ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    same = materialize(same.select(F.element_at("ids", 1).alias("rep"), F.size("v").alias("dim"), "v", F.array_distinct("ids").alias("ids")), "vectors")
    n, widest = same.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = same.agg(F.max("dim")).first()[0]
    shards = max(min(MANY, -(-n // SHARD_ROWS)), -(-n * (12 * longest + NODE_BYTES) // SHARD_BYTES))
    queries = materialize(rows.filter(is_query(F.col("id"))).select("id", "v").distinct(), "queries")
    asked = queries.select(F.size("v").alias("dim"), "v").distinct()
    # a shard's graph goes to several tasks only where there are fewer shards than tasks
    splits = max(1, -(-partitions(df.sparkSession) // shards))
    place = F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")

    def index(key: tuple, table: pa.Table) -> pa.Table:
        v = np.array(table["v"].to_pylist(), np.float64)
        order = np.argsort(table["rep"].to_numpy(), kind="stable")
        v, rep = v[order], table["rep"].to_numpy()[order]
        extra = np.sqrt(np.maximum(widest - np.einsum("ij,ij->i", v, v), 0))
        g = build(np.column_stack([v, extra]).astype(np.float32))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "reps": pa.array([rep.tobytes()], pa.binary()), "exact": pa.array([v.tobytes()], pa.binary()), "graph": pa.array([g.save()], pa.binary())})

    made = same.select("dim", place.alias("shard"), "rep", "v").groupBy("dim", "shard").applyInArrow(index, "dim int, shard int, reps binary, exact binary, graph binary")
    made = materialize(made, "graphs")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        for batch in batches:
            dims, of, kinds = (batch[c].to_numpy() for c in ("dim", "shard", "kind"))
            cuts = np.flatnonzero((dims[1:] != dims[:-1]) | (of[1:] != of[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(of)], strict=True):
                if a == b:
                    continue
                if kinds[a] == 0:
                    g, rep = Graph.load(batch["graph"][a].as_py()), np.frombuffer(batch["reps"][a].as_py(), np.int64)
                    exact = np.frombuffer(batch["exact"][a].as_py(), np.float64).reshape(len(rep), -1)
                    at = (dims[a], of[a])
                elif at == (dims[a], of[a]):  # else no vector of this length is in the shard
                    q = batch["v"].slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
                    yield from answered(g, rep, exact, q)

    def answered(g: Graph, rep: np.ndarray, exact: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(16, min(512, (1 << 25) // len(rep)))
        for a in range(0, len(q), step):
            x = q[a : a + step]
            ids = g.search(np.column_stack([x, np.zeros(len(x))]).astype(np.float32), min(ef, len(rep)))
            score = np.einsum("qd,qmd->qm", x, exact[ids])
            score[ids < 0] = -np.inf
            order = np.lexsort((rep[ids], -score), axis=1)[:, : k + 4]
            r, c = np.nonzero(np.take_along_axis(ids, order, 1) >= 0)
            at = order[r, c]
            yield pa.record_batch({"v": pa.array(list(x[r]), pa.list_(pa.float64())), "rep": pa.array(rep[ids[r, at]], pa.int64()), "score": pa.array(score[r, at], pa.float64())})

    blob = F.lit(None).cast("binary")
    split = F.pmod(F.xxhash64(F.lit(1), "v"), F.lit(splits)).cast("int")
    graphs = made.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), F.lit(0).alias("kind"), "graph", "reps", "exact", F.lit(None).cast("array<double>").alias("v"))
    dealt = asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), split.alias("split"), F.lit(1).alias("kind"), blob.alias("graph"), blob.alias("reps"), blob.alias("exact"), "v")
    both = graphs.unionByName(dealt).repartition(max(partitions(df.sparkSession), shards * splits), "shard", "split").sortWithinPartitions("shard", "split", "dim", "kind")
    with arrow_rows(df.sparkSession, QUERY_ROWS):
        found = materialize(both.mapInArrow(search, "v array<double>, rep long, score double"), "near")
    merged = found.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("score"), "rep"))).filter(F.col("nth") <= k + 4)
    merged = materialize(merged.select("v", "rep", "score"), "found")
    # ids that hold each found vector, then one ordered list a query vector
    held = same.select("rep", "ids", F.col("v").alias("rv"))
    listed = merged.join(held, "rep").filter(F.size("v") == F.size("rv")).select("v", "score", F.explode("ids").alias("id"))
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("id"))))
    lists = listed.groupBy("v").agg(F.slice(best, 1, 4 * (k + 1)).alias("best"))
    out = queries.join(lists, "v").select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k)).alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score"))
