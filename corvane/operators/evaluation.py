"""Evaluation: ground truth, ranking metrics, rubric scores, and checks of question sets."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..tables import materialize

#: Parts of the rubric.
RUBRIC = ("relevance", "factuality", "cause_reflection", "actionability", "groundedness", "specificity", "evidence_alignment")


def ground_truth(cases: DataFrame, mode: str = "auto") -> DataFrame:
    """(case_id, truth): distinct ids from relevant_ids or ground_truth_rows; a held-out source row is no truth."""
    given = F.filter(F.array_distinct("relevant_ids"), lambda x: x != "")
    rows = F.when(~F.coalesce(F.col("held_out"), F.lit(False)), F.array_distinct("ground_truth_rows")).otherwise(F.array().cast("array<string>"))
    picked = {"relevant_ids": given, "source_row": rows, "auto": F.when(F.size(F.coalesce(given, F.array())) > 0, given).otherwise(rows)}[mode]
    return cases.select("case_id", F.coalesce(picked, F.array().cast("array<string>")).alias("truth"))


def ranked_hits(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """``ranked`` (query_id, doc_id, rank from 0) with ``hit`` by ``truth`` (query_id, doc_id)."""
    marks = truth.select("query_id", "doc_id").distinct().withColumn("hit", F.lit(1))
    return ranked.join(marks, ["query_id", "doc_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))


def runtime_metrics(ranked: DataFrame, truth: DataFrame, queries: DataFrame, eval_k: int = 5) -> DataFrame:
    """recall (distinct hits by relevant), precision (hits by eval_k) and reciprocal rank; recall and rank are null without truth."""
    hits = ranked_hits(ranked.filter(F.col("rank") < eval_k), truth).filter("hit = 1")
    found = hits.groupBy("query_id").agg(F.countDistinct("doc_id").alias("matched"), F.count("*").alias("hits"), F.min("rank").alias("first"))
    relevant = truth.groupBy("query_id").agg(F.countDistinct("doc_id").alias("relevant"))
    x = queries.select("query_id").distinct().join(relevant, "query_id", "left").join(found, "query_id", "left")
    n = F.coalesce(F.col("relevant"), F.lit(0))
    return x.select(
        "query_id",
        F.when(n > 0, F.round(F.coalesce("matched", F.lit(0)) / n, 6)).alias("recall"),
        F.round(F.coalesce("hits", F.lit(0)) / F.lit(eval_k), 6).alias("precision"),
        F.when(n > 0, F.round(F.coalesce(1.0 / (F.col("first") + 1), F.lit(0.0)), 6)).alias("mrr"),
    )


def library_metrics(ranked: DataFrame, truth: DataFrame, queries: DataFrame, k: int = 10, full_ideal: bool = False) -> DataFrame:
    """hit, reciprocal rank, average precision and NDCG at ``k``.

    ``truth`` may grade (column grade). The ideal gain is made of the retrieved grades, or of all with ``full_ideal``.
    """
    graded = truth.select("query_id", "doc_id", (F.col("grade") if "grade" in truth.columns else F.lit(1)).cast("double").alias("grade")).distinct()
    top = ranked.filter(F.col("rank") < k).join(graded, ["query_id", "doc_id"], "left").withColumn("grade", F.coalesce("grade", F.lit(0.0)))
    top = top.withColumn("hit", (F.col("grade") > 0).cast("int"))
    before = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gain = lambda g, at: (F.pow(F.lit(2.0), g) - 1) / F.log2(at + 2)
    top = top.withColumn("so_far", F.sum("hit").over(before))
    ideal_rows = graded if full_ideal else top
    best = ideal_rows.withColumn("at", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("grade"), "doc_id")) - 1).filter(F.col("at") < k)
    ideal = best.groupBy("query_id").agg(F.sum(gain(F.col("grade"), F.col("at"))).alias("ideal"))
    sums = top.groupBy("query_id").agg(F.max("hit").alias("hit"), F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first"), F.sum(F.when(F.col("hit") == 1, F.col("so_far") / (F.col("rank") + 1))).alias("precisions"), F.sum(gain(F.col("grade"), F.col("rank"))).alias("dcg"))
    relevant = graded.filter("grade > 0").groupBy("query_id").agg(F.count("*").alias("relevant"))
    x = queries.select("query_id").distinct().join(sums, "query_id", "left").join(ideal, "query_id", "left").join(relevant, "query_id", "left")
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    return x.select("query_id", F.coalesce("hit", F.lit(0)).cast("int").alias("hit"), zero(1.0 / (F.col("first") + 1)).alias("mrr"), zero(F.try_divide(F.col("precisions"), F.col("relevant"))).alias("ap"), zero(F.try_divide(F.col("dcg"), F.col("ideal"))).alias("ndcg"))


def rubric(answers: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(case_id, average, score_100) of judge answers in JSON: scores clamped to 1..5 (missing: 1), weighted."""
    weights = weights or {}
    schema = ", ".join(f"{r} struct<score: double>" for r in RUBRIC)
    parsed = answers.select("case_id", F.from_json("judged", schema).alias("j"))
    clamp = lambda r: F.coalesce(F.least(F.greatest(F.col(f"j.{r}.score"), F.lit(1.0)), F.lit(5.0)), F.lit(1.0)) * float(weights.get(r, 1))
    total = sum(float(weights.get(r, 1)) for r in RUBRIC) or 1.0
    mean = reduce(Column.__add__, map(clamp, RUBRIC)) / total
    return parsed.select("case_id", F.round(mean, 3).alias("average"), F.round(mean / 5 * 100, 2).alias("score_100"))


def validate_cases(cases: DataFrame) -> DataFrame:
    """One row: number of cases, of repeated ids, of missing questions and truths, and whether all is well."""
    x = cases.agg(
        F.count("*").alias("n_cases"),
        (F.count("case_id") - F.countDistinct("case_id")).alias("n_repeated"),
        F.count_if(F.trim(F.coalesce("question", F.lit(""))) == "").alias("n_no_question"),
        F.count_if(F.size(F.coalesce("truth", F.array().cast("array<string>"))) == 0).alias("n_no_truth"),
    )
    return x.withColumn("passed", (F.col("n_repeated") == 0) & (F.col("n_no_question") == 0))


def business(answers: DataFrame) -> DataFrame:
    """(case_id, business_grade, business_score, business_revision_notes) of judge answers in JSON: a score clamped to 1..5 (missing: 1)."""
    parsed = answers.select("case_id", F.from_json("judged", "business struct<grade: string, score: double, revision_notes: string>").alias("j"))
    text = lambda k: F.trim(F.coalesce(F.col(f"j.business.{k}"), F.lit(""))).alias(f"business_{k}")
    score = F.coalesce(F.least(F.greatest(F.col("j.business.score"), F.lit(1.0)), F.lit(5.0)), F.lit(1.0))
    return parsed.select("case_id", text("grade"), score.alias("business_score"), text("revision_notes"))


def experiment(cases: DataFrame, retriever: Callable[[DataFrame], DataFrame], truth: DataFrame, model: Callable[[str], str], judge: Callable[[str], str], k: int = 3, eval_k: int = 5, limit: int | None = None) -> DataFrame:
    """One row a case (case_id, question) with a question: what was found, ranking metrics, the answer, its rubric, and errors.

    A model that fails on a case leaves its error in that row; the other cases go on. ``limit`` takes the first cases by id.
    """
    from ..functions import providers

    asked = cases.filter(F.trim(F.coalesce("question", F.lit(""))) != "")
    if limit:
        asked = asked.orderBy("case_id").limit(limit)
    asked = asked.select(F.col("case_id").alias("query_id"), F.col("question").alias("query"))
    # a few rows a case, which are written so that the search runs once and not for each use
    found = materialize(retriever(asked).filter(F.col("rank") < k), "found")
    truth = truth.join(F.broadcast(asked.select("query_id")) if limit else asked.select("query_id"), "query_id", "left_semi")
    listed = found.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "content"))), lambda x: x).alias("_found"))
    x = asked.join(listed, "query_id", "left").join(runtime_metrics(found, truth, asked, eval_k), "query_id")
    retrieved = F.transform(F.coalesce("_found", F.array().cast("array<struct<rank:bigint,doc_id:bigint,content:string>>")), lambda r: r["doc_id"])
    x = x.withColumn("retrieved", retrieved).withColumn("_a", providers.captured(F.concat_ws("\n\n", F.array_join(F.transform("_found", lambda r: r["content"]), "\n\n"), "query"), model))
    x = x.withColumn("_j", providers.captured(F.when(F.col("_a.error").isNull(), F.concat_ws("\n\n", "query", "_a.said")), judge))
    x = x.withColumns({"answer": F.coalesce("_a.said", F.lit("")), "judged": T.json_object_text(F.col("_j.said")), "error_message": F.coalesce("_a.error", "_j.error", F.lit(""))})
    scored = rubric(x.filter("judged is not null").select(F.col("query_id").alias("case_id"), "judged"))
    x = x.withColumnRenamed("query_id", "case_id").join(scored, "case_id", "left")
    return x.select("case_id", F.col("query").alias("question"), "retrieved", "recall", "precision", "mrr", "answer", F.col("average").alias("generation_average"), F.col("score_100").alias("generation_score_100"), (F.col("error_message") == "").alias("success"), "error_message")


def config_snapshot(spark: SparkSession, *parts) -> DataFrame:
    """(name, value) of every setting of ``parts`` (dataclass instances), values as JSON."""
    rows = [(f"{type(p).__name__}.{f.name}", json.dumps(getattr(p, f.name), ensure_ascii=False)) for p in parts for f in dataclasses.fields(p)]
    return spark.createDataFrame(sorted(rows), "name string, value string")
