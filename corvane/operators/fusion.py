"""Fusion of candidate lists, reranking and ordering for a context window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from .sparse import DIGITS, top_k

#: Routes in the order that breaks ties, and those with a reciprocal-rank part.
ROUTES = ("tfidf", "bm25", "vector", "mmr", "filter", "keyword")
RANKED = ("tfidf", "bm25", "vector", "mmr")


def fuse(routes: dict[str, DataFrame], pool: int = 8) -> DataFrame:
    """(query_id, doc_id, final_score, rank) of the best ``pool`` of each query.

    final = keyword score + min(20, 8 * distinct filter texts) + 100 * sum of 1 / (61 + rank) over ranked routes.
    Every route is (query_id, doc_id, rank[, score or filter_text]); one shuffle by (query_id, doc_id).
    """
    parts = []
    for name, df in routes.items():
        score = F.col("score") if name == "keyword" else F.lit(None).cast("double")
        text = F.col("filter_text") if name == "filter" else F.lit(None).cast("string")
        parts.append(df.select("query_id", "doc_id", F.lit(name).alias("route"), F.col("rank").cast("long").alias("rank"), score.cast("double").alias("score"), text.alias("text")))
    both = reduce(DataFrame.unionByName, parts)
    at = lambda r: F.min(F.when(F.col("route") == r, F.col("rank"))).alias(f"{r}_rank")
    place = F.min(F.struct(F.array_position(F.array(*[F.lit(r) for r in ROUTES]), F.col("route")).alias("p"), "rank")).alias("first_seen")
    merged = both.groupBy("query_id", "doc_id").agg(*[at(r) for r in RANKED], F.max("score").alias("keyword_score"), F.size(F.collect_set("text")).alias("hits"), place)
    reciprocal = reduce(Column.__add__, [F.coalesce(100.0 / (61 + F.col(f"{r}_rank")), F.lit(0.0)) for r in RANKED])
    final = F.coalesce("keyword_score", F.lit(0.0)) + F.least(F.lit(20), 8 * F.col("hits")) + reciprocal
    merged = merged.withColumn("final_score", F.round(final, DIGITS))
    order = Window.partitionBy("query_id").orderBy(F.desc("final_score"), "first_seen", "doc_id")
    return merged.withColumn("rank", (F.row_number().over(order) - 1).cast("long")).filter(F.col("rank") < pool).select("query_id", "doc_id", "final_score", "rank")


def first_route(routes: dict[str, DataFrame], k: int, order=("vector", "mmr", "keyword", "filter")) -> DataFrame:
    """(query_id, doc_id, route, rank): each query's first route, in ``order``, that found anything."""
    parts = [routes[r].groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank")).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.lit(i).alias("i"), F.lit(r).alias("route")) for i, r in enumerate(order) if r in routes]
    both = reduce(DataFrame.unionByName, parts)
    best = both.groupBy("query_id").agg(F.min("i").alias("i"))
    kept = both.join(best, ["query_id", "i"]).withColumnRenamed("rank", "old")
    return top_k(kept, k, score="old", descending=False).select("query_id", "doc_id", "route", "rank")


def rerank_cut(found: DataFrame, scores: Column, top_n: int = 3, k: int = 3) -> DataFrame:
    """``found`` reordered by a relevance score, cut to max(1, min(top_n, k))."""
    return top_k(found.withColumnRenamed("rank", "old_rank").withColumn("relevance", scores), max(1, min(top_n, k)), score="relevance")


def pointwise(found: DataFrame, scores: Column) -> DataFrame:
    """``found`` with ranks by a model's score of each document, earlier ranks first where they tie."""
    order = Window.partitionBy("query_id").orderBy(F.desc("points"), "rank")
    return found.withColumn("points", scores).withColumn("new", (F.row_number().over(order) - 1).cast("long")).drop("rank").withColumnRenamed("new", "rank")


def listed(found: DataFrame, longest: int) -> DataFrame:
    """(query_id, n, listing): the documents of a question, numbered from 1, as a model is shown them."""
    items = F.array_sort(F.collect_list(F.struct("rank", F.substring("content", 1, longest).alias("content"))))
    lines = F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["content"]))
    return found.groupBy("query_id").agg(F.count("*").cast("int").alias("n"), F.array_join(lines, "\n").alias("listing"))


def listwise(found: DataFrame, orders: DataFrame) -> DataFrame:
    """``found`` with ranks by a model's order of the whole list: ``orders`` (query_id, said); a question without an order keeps its ranks."""
    n = found.groupBy("query_id").agg(F.count("*").cast("int").alias("_n"))
    places = n.join(orders, "query_id").select("query_id", T.listed_order(F.regexp_replace("said", " ", ""), F.col("_n")).alias("_places"))
    moved = found.join(places, "query_id", "left")
    new = F.coalesce(F.array_position("_places", F.col("rank").cast("int")) - 1, F.col("rank"))
    return moved.withColumn("rank", new.cast("long")).drop("_places")


def closed_up(found: DataFrame) -> DataFrame:
    """Ranks from 0 without gaps."""
    return found.withColumn("rank", (F.row_number().over(Window.partitionBy("query_id").orderBy("rank")) - 1).cast("long"))


def approved(found: DataFrame, said: Column) -> DataFrame:
    """The documents that a model says YES to."""
    return closed_up(found.filter(F.contains(F.upper(F.coalesce(said, F.lit(""))), F.lit("YES"))))


def judged_evidence(found: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents with verdict 1 in a model's answer for their question: ``verdicts`` (query_id, said).

    An answer with another number of verdicts than documents is an error, as it can't be told which it left out.
    """
    n = found.groupBy("query_id").agg(F.count("*").cast("int").alias("_n"))
    marks = n.join(verdicts, "query_id", "left").select("query_id", T.verdicts(F.coalesce("said", F.lit("")), F.col("_n")).alias("_marks"), "said")
    marks = marks.select("query_id", F.coalesce("_marks", F.raise_error(F.concat(F.lit("not a verdict a document: "), F.coalesce("said", F.lit(""))))).alias("_marks"))
    kept = closed_up(found).join(marks, "query_id").filter(F.get("_marks", F.col("rank").cast("int")) == 1)
    return closed_up(kept.drop("_marks"))


def long_context_reorder(found: DataFrame) -> DataFrame:
    """Ranks interleaved so that even places come in order and odd places from the end; two or fewer stay."""
    n = F.count("*").over(Window.partitionBy("query_id"))
    half = F.floor(F.col("_n") / 2)
    # odd places, from the last one back, stand between the even ones
    new = F.when(F.col("_n") <= 2, F.col("rank")).when(F.col("rank") % 2 == 0, F.col("rank")).otherwise(2 * (half - 1 - F.floor(F.col("rank") / 2)) + 1)
    return found.withColumn("_n", n).withColumn("position", new.cast("long")).drop("_n")


def format_context(found: DataFrame) -> DataFrame:
    """(query_id, context): ``[i] location`` and the content of each, in order, a blank line between."""
    items = F.array_sort(F.collect_list(F.struct("position", "location", "content")))
    text = F.array_join(F.transform("items", lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x["location"], F.lit("\n"), x["content"])), "\n\n")
    return found.groupBy("query_id").agg(items.alias("items")).select("query_id", text.alias("context"))


def format_sources(found: DataFrame) -> DataFrame:
    """(query_id, sources): distinct source labels in order."""
    items = F.array_sort(F.collect_list(F.struct("position", "location")))
    return found.groupBy("query_id").agg(F.array_join(F.array_distinct(F.transform(items, lambda x: x["location"])), "\n").alias("sources"))
