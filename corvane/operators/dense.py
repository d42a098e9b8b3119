"""Dense retrieval: exact cosine search, thresholds and maximal marginal relevance."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .sparse import top_k

#: Rows of a block, about, and queries that are compared with a block at a time.
BLOCK = 20_000
SLICE = 256


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 where a vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def units(column: pa.Array | pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The rows of an array column by their number of components: (places, unit vectors in double precision).

    A vector without length stays as it is; rows with a null component are left out.
    """
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    sizes, flat = pc.list_value_length(a).to_numpy(zero_copy_only=False), a.flatten()
    starts, x = np.cumsum(sizes) - sizes, flat.to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.ones(len(sizes), bool)
    whole[pc.list_parent_indices(a).to_numpy()[flat.is_null().to_numpy(zero_copy_only=False)]] = False
    out = {}
    for size in np.unique(sizes[whole]):
        at = np.flatnonzero(whole & (sizes == size))
        v = x[starts[at][:, None] + np.arange(size)]
        length = np.sqrt((v * v).sum(axis=1, keepdims=True))
        out[int(size)] = at, np.divide(v, length, out=v, where=length != 0)
    return out


def _nearest_of_block(k: int, names: list[str]):
    """The ``k`` nearest of a block of vectors for each query of a block: a matrix product for some queries at a time."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")  # places are in the order that breaks ties
        qs, vs = units(asked["vector"]), units(rows["vector"])
        n, found = rows.num_rows, []
        if "cell" in rows.column_names:
            cells, cell = np.unique(rows["cell"].to_numpy(), return_inverse=True)
            opened = np.zeros((asked.num_rows, len(cells)), bool)
            own, of = pc.list_flatten(asked["cells"]).to_numpy(), pc.list_parent_indices(asked["cells"]).to_numpy()
            held = np.isin(own, cells)  # a part of a crowded cell may hold nothing
            opened[of[held], np.searchsorted(cells, own[held])] = True
        for start in range(0, asked.num_rows if n else 0, SLICE):
            m = min(SLICE, asked.num_rows - start)
            d = np.ones((m, n))
            for size in qs.keys() & vs.keys():
                (at, q), (there, v) = qs[size], vs[size]
                own = (at >= start) & (at < start + m)
                like = q[own] @ v.T
                if like.shape == d.shape:
                    d -= like
                else:
                    d[np.ix_(at[own] - start, there)] -= like
            if "cell" in rows.column_names:
                shut = ~opened[start : start + m][:, cell]
                d[shut] = np.inf
            # those that may round to the distance of the last one are looked at again, by rounded distance and place
            last = np.partition(d, k - 1, axis=1)[:, k - 1 : k] if k < n else np.full((m, 1), np.nan)
            near = (d <= last + 2e-6) | np.isnan(last)
            if "cell" in rows.column_names:
                near &= ~shut
            i, j = np.nonzero(near)
            away = np.floor(d[i, j] * 1e6 + 0.5) / 1e6 + 0.0
            order = np.lexsort((j, away, i))
            i, j, away = i[order], j[order], away[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            found.append((i[first] + start, j[first], away[first]))
        i, j, away = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.array([], int),) * 2 + (np.array([], float),)
        return pa.table([asked["query_id"].take(pa.array(i)), rows["doc_id"].take(pa.array(j)), pa.array(away)], names=names)

    return run


def nearest_in_blocks(asked: DataFrame, rows: DataFrame, keys: list[str], k: int, groups: int) -> DataFrame:
    """(query_id, doc_id, distance, rank): ``asked`` (keys, query_id, vector[, cells]) meet ``rows`` (keys, doc_id, vector[, cell]) of equal ``keys``.

    Each pair of blocks is a group of its own and leaves ``k`` rows a query. Where rows have a cell, a query meets those of its cells.
    A null component or another number of components counts as a likeness of 0.
    """
    kinds = {**{f.name: f.dataType for f in rows.schema}, **{f.name: f.dataType for f in asked.schema}}
    schema = T.StructType([T.StructField("query_id", kinds["query_id"]), T.StructField("doc_id", kinds["doc_id"]), T.StructField("distance", T.DoubleType())])
    # a stated number of partitions, as blocks are small for the time they take and would be put together
    asked, rows = asked.repartition(groups, *keys), rows.repartition(groups, *keys)
    found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(_nearest_of_block(k, schema.names), schema)
    return top_k(found, k, score="distance", descending=False)


def blocks_of(n: int) -> int:
    """Blocks of ``n`` rows: of BLOCK rows at most, about, and several of a small table, for as many tasks."""
    return max(1, min(16, -(-n // 2000)), -(-n // BLOCK))


def vector_search(queries: DataFrame, vectors: DataFrame, k: int = 12, excluded: DataFrame | None = None) -> DataFrame:
    """The ``k`` nearest, more by up to 100 for excluded ids, which are then taken out; ranks close the gaps.

    The exact scan: a stated query set against all rows. Both are dealt into blocks and every block of queries meets
    every block of rows in a task; distances are rounded to six places. Rows without a vector take no part.
    """
    extra = min(excluded.count(), 100) if excluded is not None else 0
    asked = queries.filter(F.col("vector").isNotNull()).select("query_id", "vector")
    rows = vectors.filter(F.col("vector").isNotNull()).select("doc_id", "vector")
    parts, deals = blocks_of(rows.count()), -(-asked.count() // BLOCK) or 1
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    asked = asked.withColumn("_q", block("query_id", deals)).withColumn("_d", numbers(parts))
    rows = rows.withColumn("_d", block("doc_id", parts)).withColumn("_q", numbers(deals))
    found = nearest_in_blocks(asked, rows, ["_q", "_d"], k + extra, parts * deals)
    if excluded is not None:
        found = top_k(found.drop("rank").join(excluded.select("doc_id"), "doc_id", "left_anti"), k + extra, score="distance", descending=False)
    return found.select("query_id", "doc_id", "distance", "rank")


def display_similarity(distance: Column) -> Column:
    """1 / (1 + distance), a distance below 0 counting as 0."""
    return 1 / (1 + F.greatest(distance, F.lit(0.0)))


def over_wordings(wordings: DataFrame, vectors: DataFrame, k: int = 12, excluded: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, distance, rank) for questions with several wordings (query_id, variant, vector).

    The wordings' lists follow each other; a document keeps its first place in them and its least distance.
    """
    asked = wordings.withColumn("_v", F.xxhash64("query_id", "variant"))
    found = vector_search(asked.select(F.col("_v").alias("query_id"), "vector"), vectors, k, excluded)
    found = found.withColumnRenamed("query_id", "_v").join(asked.select("_v", "query_id", "variant"), "_v")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("variant", "rank")) - 1
    return found.withColumn("place", place.cast("long")).groupBy("query_id", "doc_id").agg(F.min("distance").alias("distance"), F.min("place").alias("rank"))


def within(found: DataFrame, threshold: float = 0.9) -> DataFrame:
    return found.filter(F.col("distance") <= threshold)


def mmr(queries: DataFrame, vectors: DataFrame, k: int = 8, fetch: int = 12, weight: float = 0.5) -> DataFrame:
    """(query_id, doc_id, rank): greedy choice of ``k`` among the ``fetch`` nearest by weight * relevance - (1 - weight) * likeness to those chosen.

    Each query's candidates are at most ``fetch`` rows, so one group is small whatever the corpus.
    """
    near = vector_search(queries, vectors, fetch).join(vectors.select("doc_id", "vector"), "doc_id")
    near = near.join(queries.select("query_id", F.col("vector").alias("qv")), "query_id")

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank", kind="stable").reset_index(drop=True)
        v, q = np.stack(rows["vector"]).astype(float), np.asarray(rows["qv"][0], float)
        unit = lambda x: np.divide(x, np.linalg.norm(x, axis=-1, keepdims=True), out=np.zeros_like(x), where=np.linalg.norm(x, axis=-1, keepdims=True) > 0)
        v, q = unit(v), unit(q)
        relevance, like = v @ q, v @ v.T
        chosen: list[int] = []
        while len(chosen) < min(k, len(rows)):
            score = weight * relevance - (1 - weight) * (like[:, chosen].max(axis=1) if chosen else 0.0)
            score[chosen] = -np.inf
            chosen.append(int(np.argmax(np.round(score, 9))))
        return pd.DataFrame({"query_id": rows["query_id"][chosen].to_numpy(), "doc_id": rows["doc_id"][chosen].to_numpy(), "rank": np.arange(len(chosen))})

    return near.select("query_id", "doc_id", "rank", "vector", "qv").groupBy("query_id").applyInPandas(choose, "query_id long, doc_id long, rank long")
