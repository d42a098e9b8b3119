"""From tables and pages to documents: row documents, templates, samples, gates, blocks and figures."""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from .sizes import numbered


def row_documents(df: DataFrame, columns: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """(row, content, metadata): ``column: value`` a line for every column with a value; rows without any go. ``row`` counts from 1."""
    wanted = [c for c in columns if c not in df.columns]
    if wanted:
        raise ValueError(f"columns missing from the source: {', '.join(wanted)}")
    lines = [F.when(T.null_token(F.col(c)) != "", F.concat(F.lit(f"{c}: "), T.null_token(F.col(c)))) for c in columns]
    others = [c for c in df.columns if c not in columns] if keep is None else keep
    meta = F.create_map(*[x for c in others for x in (F.lit(c), F.col(c).cast("string"))]) if others else F.create_map().cast("map<string,string>")
    return numbered(df, order).select("row", F.concat_ws("\n", *lines).alias("content"), F.map_filter(meta, lambda k, v: v.isNotNull()).alias("metadata")).filter(F.trim("content") != "")


def source_columns(source: dict[str, str], config: dict[str, dict[str, list[str]]], default: list[str] | None, every: list[str]) -> list[str]:
    """The columns that make a source's documents: by its collection and path, or label; else the default; else all."""
    of = config.get((source.get("collection_code") or "").strip() or "DEFAULT") or {}
    path = (source.get("relative_path") or source.get("label") or "").replace("\\", "/").strip()
    for name in (path, (source.get("label") or "").strip()):
        if name in of:
            return [c for c in of[name] if c.strip()]
    return list(default or every)


def is_evaluation_source(source: dict[str, str], collection: str = "", filename: str = "") -> bool:
    """Whether evaluation rows come from a source: any, unless a collection or a file is asked for."""
    path = (source.get("relative_path") or source.get("label") or "").replace("\\", "/").strip()
    right = not collection or ((source.get("collection_code") or "").strip() or "DEFAULT") == collection
    return right and (not filename or filename in (path, (source.get("label") or "").strip()))


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All sources' rows; a column that one lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def evaluation_keys(*keys: DataFrame) -> DataFrame:
    """(source_key) once each."""
    return reduce(DataFrame.union, [k.select("source_key") for k in keys]).distinct()


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows that ``a`` has more often than ``b``, the other way round, and whether there are none."""
    count = lambda x, y, name: x.exceptAll(y).agg(F.count("*").alias(name))
    both = count(a, b, "only_a").crossJoin(F.broadcast(count(b, a, "only_b")))
    return both.withColumn("same", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def split_cases(cases: DataFrame, collection: str) -> DataFrame:
    """Evaluation cases as one collection asks them: its own question, else the case's."""
    own = F.coalesce(F.nullif(F.try_element_at("questions", F.lit(collection)), F.lit("")), F.col("question"), F.lit(""))
    return cases.withColumns({"collection_code": F.lit(collection), "question": F.trim(own)}).drop("questions")


def block_kind(loader: Column, source: Column) -> Column:
    """Whether a group is of page documents: by its loader or its name's ending."""
    return F.coalesce(F.lower(loader) == "pdf", F.lit(False)) | F.coalesce(F.endswith(F.lower(F.trim(source)), F.lit(".pdf")), F.lit(False))


def render_template(template: str, columns: list[str]) -> Column:
    """``{{column}}`` replaced by its value, empty where that stands for a missing one; spaces then become single."""
    out: Column = F.lit(template)
    for c in columns:
        out = F.replace(out, F.lit("{{" + c + "}}"), T.null_token(F.col(c), T.TEMPLATE_NULL_TOKENS))
    return F.trim(F.regexp_replace(out, r"\s{2,}", " "))


def reservoir_rows(n: int, count: int = 50, seed: int = 42) -> list[int]:
    """Row numbers from 1 that a seeded reservoir of ``count`` keeps of ``n`` rows; only numbers are held."""
    rng, kept = random.Random(seed), list(range(1, min(n, count) + 1))
    for i in range(count, n):
        j = rng.randint(0, i)
        if j < count:
            kept[j] = i + 1
    return sorted(kept)


def reservoir_sample(rows: DataFrame, count: int = 50, seed: int = 42) -> DataFrame:
    """The ``rows`` (row from 1) that the reservoir keeps: a join with at most ``count`` numbers."""
    chosen = reservoir_rows(rows.count(), count, seed)
    kept = rows.sparkSession.createDataFrame([(r,) for r in chosen], "row long")
    return rows.join(F.broadcast(kept), "row", "left_semi")


def hash_sample(df: DataFrame, key: str, count: int, seed: int = 42) -> DataFrame:
    """``count`` rows by the SHA-256 of seed and key: the same on any engine, in one pass."""
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    return df.withColumn("_h", h).orderBy("_h", key).limit(count).drop("_h")


def holdout(df: DataFrame, sampled: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(corpus, evaluation rows)."""
    keys = sampled.select(key)
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def sanitize_metadata(meta: Column) -> tuple[Column, Column]:
    """(metadata without sensitive keys, names of the keys taken out)."""
    sensitive = lambda k: F.lower(k).isin(*T.SENSITIVE_KEYS)
    return F.map_filter(meta, lambda k, v: ~sensitive(k)), F.array_sort(F.filter(F.map_keys(meta), sensitive))


def quality_issues(docs: DataFrame) -> DataFrame:
    """(doc_id, issue): personal data left in the content, or text that needs review."""
    issues = F.array_compact(F.array(F.when(F.size(T.pii_kinds(F.col("content"))) > 0, F.lit("pii")), F.when(F.coalesce("needs_review", F.lit(False)), F.lit("review"))))
    return docs.select("doc_id", F.explode(issues).alias("issue"))


def quality_gate(docs: DataFrame) -> DataFrame:
    """``docs``, or an error if any has an issue."""
    n = quality_issues(docs).limit(1).count()
    if n:
        raise ValueError("documents with personal data or unreviewed text")
    return docs


def block_class(loader: Column, block_type: Column) -> Column:
    return F.when(loader.isin("csv", "openpyxl"), "structured").when((loader == "pdf") & (F.coalesce(block_type, F.lit("text")) == "text"), "text").when(block_type.isin("table", "image"), "standalone").otherwise("other")


def needs_ocr(text: Column, mode: str = "auto", use_ocr: bool = True, least: int = 40) -> Column:
    return F.lit(True) if mode == "ocr" else (F.length(F.trim(text)) < least) & F.lit(mode == "auto" and use_ocr)


def ocr_text(lines: Column, least_confidence: float = 0.7) -> tuple[Column, Column]:
    """(text of lines with enough confidence, mean confidence of those) from an array of (text, confidence)."""
    good = F.filter(lines, lambda x: x["confidence"] >= least_confidence)
    mean = F.try_divide(F.aggregate(good, F.lit(0.0), lambda a, x: a + x["confidence"]), F.size(good))
    return F.array_join(F.transform(good, lambda x: x["text"]), "\n"), mean


def table_text(rows: Column) -> Column:
    """Cells joined by `` | ``, rows of nothing but bars left out."""
    joined = F.transform(rows, lambda r: F.array_join(F.transform(r, lambda c: F.trim(F.coalesce(c, F.lit("")))), " | "))
    return F.array_join(F.filter(joined, lambda x: F.regexp_replace(x, r"[|\s]", "") != ""), "\n")


def figure_text(caption: Column, ocr: Column, description: Column, page: Column) -> Column:
    part = lambda label, c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(label), F.trim(c)))
    whole = F.concat_ws("\n\n", part("Caption: ", caption), part("OCR:\n", ocr), part("Description: ", description))
    return F.when(whole != "", whole).otherwise(F.concat(F.lit("Figure from page "), page.cast("string")))


def html_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, block, kind, content): headings, paragraphs, table cells and images of a page in order."""
    tag = r"(?is)<(h[1-6]|p|td|th|li|title)\b[^>]*>(.*?)</\1>"
    both = pages.select("page_id", F.regexp_extract_all("html", F.lit(tag), F.lit(1)).alias("k"), F.regexp_extract_all("html", F.lit(tag), F.lit(2)).alias("c"))
    rows = both.select("page_id", F.posexplode(F.arrays_zip("k", "c")).alias("block", "x"))
    clean = F.trim(F.regexp_replace(F.regexp_replace("x.c", r"(?s)<[^>]*>", " "), r"\s+", " "))
    kind = F.lower(F.col("x.k"))
    name = F.when(kind.rlike("^h[1-6]$|^title$"), "heading").when(kind.isin("td", "th"), "table").otherwise("text")
    return rows.select("page_id", F.col("block").cast("long").alias("block"), name.alias("kind"), clean.alias("content")).filter("content <> ''")


# ------------------------------------------------------------------ page geometry

def figure_regions(rects: DataFrame, gap: float = 28, overlap: float = 0.18, pad: float = 8) -> DataFrame:
    """(page_id, x0, y0, x1, y1) of figures: image rectangles of a page, cut to it, that touch or nearly do are one.

    Rectangles that agree to a tenth of a point count once. A figure is the hull of its rectangles; those that fill the
    page, as scans do, and small or thin ones go. Pages are the groups, which lie in a partition one after the other; rectangles of a page are swept from left to right.
    """

    names = ["page_id", "x0", "y0", "x1", "y1"]

    def regions(page: int | None, rows: list[tuple]) -> list[tuple]:
        width, height = float(rows[0][5]), float(rows[0][6])
        seen: dict[tuple, list[float]] = {}
        for _, x0, y0, x1, y1, _, _ in rows:
            box = [min(max(float(v), 0.0), most) for v, most in ((x0, width), (y0, height), (x1, width), (y1, height))]
            if box[2] - box[0] > 2 and box[3] - box[1] > 2:
                seen.setdefault(tuple(round(v, 1) for v in box), box)
        boxes = list(seen.values())
        clusters: dict[int, list[list[float]]] = {}
        for b, c in zip(boxes, joined_boxes(boxes, gap, overlap), strict=True):
            clusters.setdefault(c, []).append(b)
        out = []
        for own in clusters.values():
            x0, y0, x1, y1 = *(min(b[k] for b in own) for k in (0, 1)), *(max(b[k] for b in own) for k in (2, 3))
            w, h = x1 - x0, y1 - y0
            share = w * h / max(1.0, width * height)
            if 0.0015 <= share < 0.88 and min(w, h) >= 34 and max(w / h, h / w) <= 12:
                out.append((page, max(0.0, x0 - pad), max(0.0, y0 - pad), min(width, x1 + pad), min(height, y1 + pad)))
        return sorted(out, key=lambda r: (r[2], r[1]))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.float64()) for c in cols[1:])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # many small pages a batch; one page may go over several
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple] = []
        for page, own in groupby(rows, key=lambda r: r[0]):
            out += regions(page, list(own))
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    spread = rects.select(*names, "width", "height").repartition(int(rects.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page_id")
    return spread.sortWithinPartitions("page_id").mapInArrow(run, "page_id long, x0 double, y0 double, x1 double, y1 double")


#: Boxes of a page up to which they are compared one by one, as arrays cost more than they save.
FEW_BOXES = 24


def _few_joined(boxes: list[list[float]], gap: float, overlap: float) -> list[int]:
    """joined_boxes by comparing all pairs."""
    label = list(range(len(boxes)))
    for i, a in enumerate(boxes):
        for j in range(i + 1, len(boxes)):
            if label[i] == label[j]:
                continue
            b = boxes[j]
            across, down = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
            touch = across >= 0 and down >= 0
            if touch or (-down <= gap and max(across, 0.0) >= overlap * min(a[2] - a[0], b[2] - b[0])) or (-across <= gap and max(down, 0.0) >= overlap * min(a[3] - a[1], b[3] - b[1])):
                new, old = min(label[i], label[j]), max(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def joined_boxes(boxes: list[list[float]], gap: float, overlap: float) -> list[int]:
    """A cluster number for each box (x0, y0, x1, y1): those that are joined, also through others, have the same one.

    Two are joined if they touch, or are apart by at most ``gap`` on one axis while they share at least ``overlap`` of the
    smaller side on the other. In a sweep by x0 a box is compared with those that begin at most ``gap`` beyond its end.
    """
    if len(boxes) <= FEW_BOXES:
        return _few_joined(boxes, gap, overlap)
    given = np.array(boxes, float)
    order = np.argsort(given[:, 0], kind="stable")
    x0, y0, x1, y1 = given[order].T
    parent = list(range(len(boxes)))
    label = np.arange(len(boxes))  # a box's cluster as it was when last seen

    def find(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    ends = np.searchsorted(x0, np.nextafter(x1 + gap, np.inf), side="right")
    for i, end in enumerate(ends):
        j = slice(i + 1, end)
        across, down = (np.minimum(hi[i], hi[j]) - np.maximum(lo[i], lo[j]) for lo, hi in ((x0, x1), (y0, y1)))
        sides = [overlap * np.minimum(hi[i] - lo[i], hi[j] - lo[j]) for lo, hi in ((x0, x1), (y0, y1))]
        near = (np.minimum(across, down) >= 0) | ((-down <= gap) & (np.maximum(across, 0) >= sides[0])) | ((-across <= gap) & (np.maximum(down, 0) >= sides[1]))
        hit = i + 1 + np.flatnonzero(near)
        root = find(int(label[i]))
        for c in np.unique(label[hit]):
            if (other := find(int(c))) != root:
                root, other = min(root, other), max(root, other)
                parent[other] = root
        label[hit] = label[i] = root
    out = [0] * len(boxes)
    for k, c in zip(order.tolist(), label.tolist(), strict=True):
        out[k] = find(c)
    return out


def nearest_caption(figures: DataFrame, blocks: DataFrame, most: float = 120, longest: int = 300) -> DataFrame:
    """(page_id, figure_id, caption): a short text block over or under a figure, below before above, then the nearest, then the shortest."""
    flat = blocks.withColumn("content", F.trim(F.regexp_replace("content", r"\s+", " ")))
    b = flat.filter((F.col("content") != "") & (F.length("content") <= longest)).select(F.col("page_id").alias("b_page"), F.col("x0").alias("bx0"), F.col("y0").alias("by0"), F.col("x1").alias("bx1"), F.col("y1").alias("by1"), "content")
    both = figures.join(b, (F.col("page_id") == F.col("b_page")) & (F.least("x1", "bx1") > F.greatest("x0", "bx0")))
    side = F.when(F.col("by0") >= F.col("y1"), 0).when(F.col("by1") <= F.col("y0"), 1).otherwise(2)
    away = F.when(side == 0, F.col("by0") - F.col("y1")).when(side == 1, F.col("y0") - F.col("by1")).otherwise(0.0)
    best = both.withColumn("away", away).filter(F.col("away") <= most).groupBy("page_id", "figure_id").agg(F.min(F.struct(side.alias("side"), "away", F.length("content").alias("n"), "content")).alias("x"))
    return best.select("page_id", "figure_id", F.col("x.content").alias("caption"))


def heading_candidates(lines: DataFrame) -> DataFrame:
    """(page_id, y, content, level): lines much larger than the page's upper median size, or numbered ones; at most 50 a page, texts once."""
    sizes = lines.filter(F.length("content") <= 180).groupBy("page_id").agg(F.array_sort(F.collect_list("size")).alias("s"))
    median = sizes.select("page_id", F.element_at("s", (F.floor(F.size("s") / 2) + 1).cast("int")).alias("median"))
    ratio = F.col("size") / F.col("median")
    level = F.when(ratio >= 1.45, 1).when(ratio >= 1.25, 2).otherwise(3)
    found = lines.filter(F.length("content") <= 180).join(median, "page_id").filter((ratio >= 1.18) | T.heading_level(F.col("content")).isNotNull())
    once = found.groupBy("page_id", "content").agg(F.min(F.struct("y", level.alias("level"))).alias("x")).select("page_id", "content", "x.y", "x.level")
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("y", "content"))
    return once.withColumn("nth", nth).filter("nth <= 50").select("page_id", "y", "content", "level")
