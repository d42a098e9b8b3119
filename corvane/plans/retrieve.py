"""retrieve and answer: routes, fusion, reranking and context of many questions as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import providers
from ..functions import text as T
from ..operators import dense, fusion, sparse
from ..tables import materialize

REFUSAL = "no evidence was found for this question"


@dataclass(frozen=True)
class Settings:
    """Routes on and off, sizes and thresholds."""

    tfidf: bool = False
    bm25: bool = True
    vector: bool = True
    mmr: bool = False
    where_document: bool = True
    keyword: bool = True
    hybrid: bool = True
    rerank: bool = True
    guard: bool = False
    reorder: bool = True
    k: int = 3
    candidates: int = 12
    pool: int = 8
    mmr_fetch: int = 8
    mmr_weight: float = 0.5
    #: Evidence for answers: cosine distance up to the threshold, then a model's verdicts.
    validate: bool = True
    threshold: float = 0.9
    #: Vectors of other wordings are made by the embedding provider; else only the question itself is searched by vector.
    embed_variants: bool = False


def expand(questions: DataFrame, variants: Callable[[str], list[str]] | None = None, parts: Callable[[str], list[str]] | None = None) -> DataFrame:
    """(query_id, variant, query): the question, a model's other wordings of it, and its parts if there are several, once each in this order."""
    said = [F.array("query")]
    if variants is not None:
        said.append(T.model_lines(providers.answer(F.col("query"), lambda q: "\n".join(variants(q))), 3))
    if parts is not None:
        found = T.model_lines(providers.answer(F.col("query"), lambda q: "\n".join(parts(q))), 4)
        said.append(F.when(F.size(found) > 1, found).otherwise(F.array().cast("array<string>")))
    every = F.array_distinct(F.filter(F.concat(*said), lambda x: x != ""))
    return questions.select("query_id", F.posexplode(every).alias("variant", "query"))


def excluded_rows(corpus: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id) of the corpus (doc_id, sheet, row) that are evaluation rows: ``keys`` (sheet, row); an empty sheet stands for any, a row that is no number is none."""
    rows = corpus.select("doc_id", "sheet", T.regex_int(F.col("row").cast("string")).alias("row")).filter("row is not null")
    k = keys.select(F.col("sheet").alias("k_sheet"), F.col("row").cast("int").alias("k_row")).distinct()
    return rows.join(k, (F.col("row") == F.col("k_row")) & ((F.col("sheet") == F.col("k_sheet")) | (F.col("k_sheet") == "")), "left_semi").select("doc_id")


def routes(questions: DataFrame, corpus: DataFrame, s: Settings, wordings: DataFrame | None = None, excluded: DataFrame | None = None, vectors: DataFrame | None = None) -> dict[str, DataFrame]:
    """Each route's candidates. questions (query_id, query[, vector]), corpus (doc_id, content, heading[, vector]).

    ``vectors`` (doc_id, vector) of documents of the corpus may stand beside it, so that no route joins them to its texts.

    ``wordings`` (query_id, variant, query[, vector]) stand for the questions: each is searched by itself in the tfidf,
    bm25 and vector routes; terms are taken from all of them together. ``excluded`` (doc_id) are no candidates of the
    vector, mmr and filter routes.
    """
    out: dict[str, DataFrame] = {}
    if vectors is None and "vector" in corpus.columns:
        vectors = corpus.select("doc_id", "vector")
    near = vectors is not None
    asked = questions
    if wordings is not None:
        line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("variant", "query"))), lambda x: x["query"]), " | ")
        asked = wordings.groupBy("query_id").agg(line.alias("query"))
        if "vector" in questions.columns:
            asked = asked.join(questions.select("query_id", "vector"), "query_id")
    without = lambda df: df.join(excluded.select("doc_id"), "doc_id", "left_anti") if excluded is not None else df
    lexical = lambda search: search(questions, corpus, s.candidates) if wordings is None else sparse.over_variants(search, wordings.select("query_id", "query"), corpus, s.candidates)
    if s.tfidf:
        out["tfidf"] = lexical(sparse.tfidf)
    if s.bm25:
        out["bm25"] = lexical(sparse.bm25)
    if s.vector and near:
        several = wordings is not None and "vector" in wordings.columns
        out["vector"] = dense.over_wordings(wordings, vectors, s.candidates, excluded) if several else dense.vector_search(questions, vectors, s.candidates, excluded)
    if s.mmr and near:
        out["mmr"] = dense.mmr(questions, without(vectors), max(s.k, min(8, s.candidates)), max(s.mmr_fetch, s.k), s.mmr_weight)
    if s.where_document:
        out["filter"] = sparse.where_document(asked, without(corpus), vectors=vectors)
    if s.keyword:
        out["keyword"] = sparse.keyword(asked, corpus, s.candidates)
    return out


def retrieve(
    questions: DataFrame, corpus: DataFrame, s: Settings | None = None, reranker: Callable | None = None, *, variants: Callable | None = None, parts: Callable | None = None,
    rate: Callable[[str], str] | None = None, order: Callable[[str], str] | None = None, needed: Callable[[str], str] | None = None, excluded: DataFrame | None = None, vectors: DataFrame | None = None,
) -> DataFrame:
    """(query_id, doc_id, content, score, rank, position) of the ``k`` best of each question.

    Models are callables from a prompt to an answer: ``variants`` and ``parts`` word the question anew, ``rate`` gives
    points to each document, ``order`` puts a question's documents in order, ``needed`` says YES to those to keep.
    """
    s = s or Settings()
    if s.guard:
        questions = questions.filter(~T.is_injection(F.col("query")))
    wordings = expand(questions, variants, parts) if variants or parts else None
    if wordings is not None and "vector" in questions.columns and s.embed_variants:
        wordings = wordings.join(questions.select("query_id", "vector"), "query_id").withColumn("vector", F.when(F.col("variant") == 0, F.col("vector")).otherwise(providers.embed(F.col("query"))))
    found = routes(questions, corpus, s, wordings, excluded, vectors)
    pool = max(s.k, s.pool if s.rerank else s.k)
    fused = fusion.fuse(found, pool) if s.hybrid else fusion.first_route(found, pool).withColumn("final_score", F.lit(0.0))
    full = fused.select("query_id", "doc_id", "final_score", "rank").join(corpus.select("doc_id", "content", "heading"), "doc_id")
    ask = questions.select("query_id", "query")
    if s.rerank and reranker is not None:
        full = fusion.rerank_cut(full.join(ask, "query_id"), providers.relevance(F.col("query"), F.col("content"), reranker), s.k, s.k).withColumn("final_score", F.col("relevance")).drop("query")
    else:
        full = full.filter(F.col("rank") < s.k)
    if rate is not None:
        full = fusion.pointwise(full.join(ask, "query_id"), providers.rated(F.col("query"), F.col("content"), rate)).drop("query")
    if order is not None:
        shown = fusion.listed(full, 1200).join(ask, "query_id").filter("n > 1")
        full = fusion.listwise(full, shown.select("query_id", providers.answer(F.concat_ws("\n", "query", "listing"), lambda p: providers.quietly(order, p)).alias("said")))
    if needed is not None:
        prompt = F.concat_ws("\n", "query", F.substring("content", 1, 3000))
        full = fusion.approved(full.join(ask, "query_id").withColumn("said", providers.answer(prompt, lambda p: providers.quietly(needed, p))), F.col("said")).drop("query", "said")
    out = fusion.long_context_reorder(full) if s.reorder else full.withColumn("position", F.col("rank"))
    return out.select("query_id", "doc_id", "content", "heading", F.col("final_score").alias("score"), "rank", "position")


def validated(found: DataFrame, questions: DataFrame, corpus: DataFrame, threshold: float | None = 0.9, judge: Callable[[str], str] | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """The evidence among ``found``: documents within ``threshold`` of their question by cosine distance, then those a model gives verdict 1.

    Vectors are those of ``questions`` and ``corpus``, or made of the texts where there are none. The model sees all of
    a question's documents in one prompt and answers with a 0 or 1 for each.
    """
    if threshold is not None:
        vector = lambda df, text: F.col("vector") if "vector" in df.columns else providers.embed(F.col(text))
        q = questions.select("query_id", vector(questions, "query").alias("_qv"))
        of = corpus if vectors is None else vectors
        d = of.join(found.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", vector(of, "content").alias("_dv"))
        away = F.round(1 - dense.cosine(F.col("_qv"), F.col("_dv")), 6)
        found = fusion.closed_up(found.join(q, "query_id").join(d, "doc_id").filter(away <= threshold).drop("_qv", "_dv"))
    if judge is not None:
        shown = fusion.listed(found, 3000).join(questions.select("query_id", "query"), "query_id")
        found = fusion.judged_evidence(found, shown.select("query_id", providers.answer(F.concat_ws("\n", "query", "listing"), judge).alias("said")))
    return found


def answers(
    questions: DataFrame, corpus: DataFrame, model: Callable[[str], str], s: Settings | None = None, *, judge: Callable[[str], str] | None = None, shorten: Callable[[str], str] | None = None, longest: int = 8000, vectors: DataFrame | None = None, **models
) -> DataFrame:
    """(query_id, answer, sources): a model's answer from the validated evidence, or a refusal where there is none.

    A context of over ``longest`` characters is first made shorter by ``shorten``.
    """
    s = s or Settings()
    # a few rows a question, which are written so that the routes run once and not for each use
    found = materialize(retrieve(questions, corpus, s, vectors=vectors, **models), "found")
    evidence = validated(found, questions, corpus, s.threshold, judge, vectors) if s.validate else found
    evidence = (fusion.long_context_reorder(evidence.drop("position")) if s.reorder else evidence.withColumn("position", F.col("rank"))).withColumn("location", F.col("heading"))
    context = fusion.format_context(evidence)
    if shorten is not None:
        long = F.when(F.length("context") > longest, F.col("context"))
        context = context.withColumn("context", F.coalesce(providers.answer(long, shorten), "context"))
    both = context.join(fusion.format_sources(evidence), "query_id")
    x = questions.select("query_id", "query").join(both, "query_id", "left")
    prompt = F.when(F.col("context").isNotNull(), F.concat_ws("\n\n", "context", "query"))
    return x.select("query_id", F.coalesce(providers.answer(prompt, model), F.lit(REFUSAL)).alias("answer"), F.coalesce("sources", F.lit("")).alias("sources"))
