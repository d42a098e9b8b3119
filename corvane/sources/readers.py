"""Readers: delimited files with a choice of encodings, files as bytes, question sets, and stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null

ENCODINGS = ("utf-8-sig", "utf-8", "cp949", "euc-kr")


def pick_encoding(head: bytes, encodings=ENCODINGS, whole: bool = False) -> str:
    """The first encoding that reads the start of a file; a character cut at its end doesn't count."""
    for e in encodings:
        for cut in range(1 if whole else 4):
            try:
                head[: len(head) - cut].decode(e)
                return e
            except UnicodeDecodeError:
                continue
    raise ValueError("none of the encodings reads the file")


def read_csv(spark: SparkSession, path: str, encodings=ENCODINGS, probe: int = 1 << 16) -> DataFrame:
    """Every column as text, by the header; the encoding is chosen from the file's first bytes, read by Spark."""
    first = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, probe).alias("head"), "length").limit(1).first()
    encoding = pick_encoding(bytes(first["head"]), encodings, first["length"] <= probe) if first else "utf-8"
    if encoding in ("utf-8", "utf-8-sig"):
        df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', encoding="UTF-8")
        return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    return _decoded_csv(spark, path, encoding)


def _decoded_csv(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """A delimited file in an encoding that Spark's own reader refuses: decoded and parsed a file at a time."""
    import csv
    import io

    import pandas as pd

    def run(frames):
        for f in frames:
            for content in f["content"]:
                rows = list(csv.reader(io.StringIO(content.decode(encoding), newline="")))
                yield pd.DataFrame({"n": range(len(rows)), "cells": rows})

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "n long, cells array<string>")
    header = rows.filter("n = 0").select("cells").first()
    names = header.cells if header else []
    return rows.filter("n > 0").select(*[F.get("cells", i).alias(c) for i, c in enumerate(names)])


def read_files(spark: SparkSession, path: str, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """(source, page, page_number, content) of binary files, their text by ``extract`` (bytes to a list of pages)."""
    import pandas as pd

    def run(frames):
        for f in frames:
            rows = [(p, i, i + 1, t) for p, c in zip(f["path"], f["content"], strict=True) for i, t in enumerate(extract(c))]
            yield pd.DataFrame(rows, columns=["source", "page", "page_number", "content"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "source string, page int, page_number int, content string")


#: Readers by kind; more are added with ``LOADERS[kind] = function(spark, path)``.
LOADERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": read_csv,
    "parquet": lambda spark, path: spark.read.parquet(path),
    "json": lambda spark, path: spark.read.json(path, multiLine=True),
}


def load(spark: SparkSession, kind: str, path: str) -> DataFrame:
    if kind not in LOADERS:
        raise ValueError(f"no loader for {kind}")
    return LOADERS[kind](spark, path)


def tagged(df: DataFrame, group: str | None, collection: str | None, policy: str | None) -> DataFrame:
    """Columns that say where documents come from and how repeats are treated."""
    return df.withColumns({
        "registration_group_id": F.lit(group or ""),
        "collection_code": F.lit((collection or "").strip() or "DEFAULT"),
        "duplicate_policy": F.lit((policy or "").strip() or "update_changed"),
    })


def source_identity(relative_path: Column, source: Column, filename: Column) -> Column:
    return F.coalesce(blank_to_null(relative_path), blank_to_null(source), blank_to_null(filename), F.lit(""))


def file_signature(spark: SparkSession, path: str, settings: str) -> DataFrame:
    """(path, signature): SHA-256 of the file's own SHA-256 and the settings, the key of a preprocess cache."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2(F.concat(F.sha2("content", 256), F.lit(settings)), 256).alias("signature"))


def cache_misses(signatures: DataFrame, cached: DataFrame) -> DataFrame:
    return signatures.join(cached.select("signature"), "signature", "left_anti")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """(source, source_row, collection_code, question) of a question-set file."""
    cases = spark.read.json(path, multiLine=True).select(F.explode("cases").alias("c"))
    return cases.select("c.source", F.col("c.source_row").cast("long").alias("source_row"), "c.collection_code", "c.question")


def merged_questions(sets: DataFrame) -> DataFrame:
    """(source, source_row, questions): the sets' questions of one case by collection."""
    pairs = F.map_from_entries(F.array_sort(F.collect_set(F.struct("collection_code", "question"))))
    return sets.groupBy("source", "source_row").agg(pairs.alias("questions"))
