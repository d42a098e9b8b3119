"""Writers: question sets with a check, manifests, appended results, and metrics of a run."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def file_code(c: Column) -> Column:
    """A collection's name as part of a file name."""
    safe = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9A-Za-z가-힣._-]+", "_"), "^[._-]+|[._-]+$", ""))
    return F.when(safe == "", "collection").otherwise(safe)


def write_checked(df: DataFrame, path: str, kind: str = "json") -> int:
    """Write ``df``, read it back and compare the number of rows."""
    df.write.mode("overwrite").format(kind).save(path)
    wrote, there = df.count(), df.sparkSession.read.schema(df.schema).format(kind).load(path).count()
    if wrote != there:
        raise RuntimeError(f"{there} of {wrote} rows can be read at {path}")
    return there


def write_counted(df: DataFrame, path: str, **counts: Column) -> dict[str, int]:
    """Write ``df`` and return ``counts`` (aggregates of it by name), taken by the write itself as its rows pass."""
    seen = Observation("counts")
    df.observe(seen, *[c.alias(name) for name, c in counts.items()]).write.mode("overwrite").parquet(path)
    return seen.get


def write_question_sets(cases: DataFrame, collections: list[str], path: str) -> dict:
    """A folder of cases a collection, and a manifest of them; each is read back and counted.

    cases (source, source_sheet, source_row, question, questions); collections are those of the configuration, a few.
    """
    from ..operators.ingest import same_rows, split_cases

    spark, n, sets = cases.sparkSession, cases.count(), {}
    for code in collections:
        name = spark.range(1).select(file_code(F.lit(code)).alias("c")).first()["c"]
        own = split_cases(cases, code)
        sets[code] = {"folder": f"{name}_evaluation_set_{n}", "count": write_checked(own, f"{path}/{name}_evaluation_set_{n}")}
    manifest = spark.createDataFrame([(c, x["folder"], x["count"]) for c, x in sets.items()], "collection_code string, folder string, count long")
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    if not same_rows(manifest, spark.read.schema(manifest.schema).json(f"{path}/manifest")):
        raise RuntimeError(f"the manifest at {path} can't be read back")
    return sets


def read_question_sets(spark: SparkSession, path: str) -> DataFrame:
    """(source, source_sheet, source_row, questions) of the sets that the manifest at ``path`` names: a case's questions by collection."""
    sets = spark.read.schema("collection_code string, folder string, count long").json(f"{path}/manifest").collect()
    schema = "source string, source_sheet string, source_row long, collection_code string, question string"
    cases = spark.read.schema(schema).json([f"{path}/{r.folder}" for r in sets])
    by_collection = F.map_from_entries(F.array_sort(F.collect_set(F.struct("collection_code", "question"))))
    return cases.groupBy("source", "source_sheet", "source_row").agg(by_collection.alias("questions"))


def manifest_signature(settings: dict) -> str:
    """SHA-256 of settings as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(settings, ensure_ascii=False, sort_keys=True, default=str).encode()).hexdigest()


def check_manifest(saved: dict | None, now: dict, force: bool = False) -> None:
    """An error where an index was built with other settings, unless it is to be built anew."""
    if saved and not force and manifest_signature(saved) != manifest_signature(now):
        raise RuntimeError("the index was built with other chunking or embedding settings; force a rebuild to use these")


def asset_manifest(docs: DataFrame) -> DataFrame:
    """(source, n, assets): the image blocks of a source as JSON."""
    images = docs.filter(F.col("block_type") == "image")
    item = F.struct("page_number", "image_index", "image_path", "caption")
    return images.groupBy("source").agg(F.count("*").alias("n"), F.to_json(F.array_sort(F.collect_list(item))).alias("assets"))


def append_results(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """Results so far with new ones whose key isn't there; columns that one side lacks are null."""
    if old is None:
        return new
    fresh = new.join(old.select(key), key, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def progress(batches: DataFrame) -> DataFrame:
    """Running average of seconds and the estimate of what is left, from (n, total, seconds)."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("total").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    average = F.avg("seconds").over(w)
    return batches.select("n", F.round(average, 3).alias("average"), F.round(average * (F.col("total") - F.col("n")), 3).alias("eta"))
