"""Versioned corpus state: change detection, snapshots and the sync of common tables.

Sources are (collection_code, source_key, source_hash, seq): what arrives, in order. State is one row a version.
A source's versions are decided from its own arrivals alone, so everything is partitioned by source key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blank_to_null, regex_int, stable_json
from ..tables import materialize, scope

KEY = ["collection_code", "source_key"]
#: Documents, and places of chunks of theirs, up to which they are broadcast to a sync's chunks.
MOST_OWNERS = 200_000


def logical_source_key(source: Column, kind: Column, sheet: Column, row: Column, item: Column) -> Column:
    """``source::sheet=..::row=n`` for rows of tables, ``source::item=n`` for items of JSON, else the source."""
    by_row = F.concat(source, F.lit("::sheet="), F.coalesce(sheet, F.lit("")), F.lit("::row="), row.cast("string"))
    return F.when(kind.isin("csv", "openpyxl") & row.isNotNull(), by_row).when((kind == "json") & item.isNotNull(), F.concat(source, F.lit("::item="), item.cast("string"))).otherwise(source)


def chunk_hash(content: Column, metadata: Column) -> Column:
    """SHA-256 of the content and its business metadata: positions are left out, so that a shift changes nothing."""
    business = F.map_filter(metadata, lambda k, v: ~k.isin("start_index", "chunk_index"))
    return F.sha2(F.concat(content, F.lit("\n"), stable_json(business)), 256)


def document_key(version_id: Column, hash_: Column) -> Column:
    return F.sha2(F.concat_ws(":", version_id.cast("string"), hash_), 256)


def version_history(arrivals: DataFrame) -> DataFrame:
    """Every arrival with its decision (new, changed, same) and version: an arrival is compared with the latest before it."""
    w = Window.partitionBy(*KEY).orderBy("seq")
    last = F.lag("source_hash").over(w)
    kind = F.when(F.row_number().over(w) == 1, "new").when(last.eqNullSafe(F.col("source_hash")), "same").otherwise("changed")
    decided = arrivals.withColumn("change_kind", kind)
    return decided.withColumn("version", F.sum((F.col("change_kind") != "same").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def snapshot(arrivals: DataFrame) -> DataFrame:
    """One row a version: when it began, when it was superseded (null while active)."""
    begun = version_history(arrivals).filter("change_kind <> 'same'")
    after = F.lead("seq").over(Window.partitionBy(*KEY).orderBy("version"))
    out = begun.withColumn("superseded_at", after)
    return out.select(*KEY, "version", "source_hash", F.col("seq").alias("valid_from"), "superseded_at", F.col("superseded_at").isNull().alias("is_active"))


def latest(state: DataFrame) -> DataFrame:
    """The newest version of each source."""
    newest = state.groupBy(*KEY).agg(F.max(F.struct("version", "source_hash", "is_active")).alias("x"))
    return newest.select(*KEY, "x.version", "x.source_hash", "x.is_active")


def decide(incoming: DataFrame, state: DataFrame, policy: str = "update_changed", rebuild: bool = False) -> DataFrame:
    """What to do with each incoming source: action (skip, insert), version and change_kind, by a duplicate policy.

    update_changed and skip_same skip a source whose active version has the same hash; skip_same also one whose
    latest, inactive version has; force inserts always. An insert of the latest hash keeps its version number.
    """
    old = latest(state).select(*KEY, F.col("version").alias("old_version"), F.col("source_hash").alias("old_hash"), F.col("is_active").alias("old_active"))
    x = incoming.join(old, KEY, "left")
    same = F.col("old_hash").eqNullSafe(F.col("source_hash")) & F.col("old_version").isNotNull()
    force = F.lit(policy == "force" or rebuild)
    skip = same & ~force & (F.col("old_active") | F.lit(policy == "skip_same"))
    kind = F.when(F.col("old_version").isNull(), "new").when(same, "same").otherwise("changed")
    version = F.when(F.col("old_version").isNull(), 1).when(same, F.col("old_version")).otherwise(F.col("old_version") + 1)
    counter = F.when(skip, "same").when(kind == "changed", "changed").otherwise("new")
    return x.select(*KEY, "source_hash", F.when(skip, "skip").otherwise("insert").alias("action"), version.cast("long").alias("version"), kind.alias("change_kind"), counter.alias("counter"))


def merge(state: DataFrame, incoming: DataFrame, at: Column, policy: str = "update_changed") -> DataFrame:
    """The state after one batch: inserted sources' active versions end, new ones begin. Sources that don't arrive stay."""
    decided = decide(incoming, state, policy).filter("action = 'insert'")
    ended = state.join(decided.select(*KEY, F.lit(True).alias("_new")), KEY, "left")
    ends = F.col("_new") & F.col("is_active")
    ended = ended.withColumn("superseded_at", F.when(F.coalesce(ends, F.lit(False)), F.coalesce("superseded_at", at)).otherwise(F.col("superseded_at"))).withColumn("is_active", F.col("is_active") & F.col("_new").isNull()).drop("_new")
    begun = decided.select(*KEY, "version", "source_hash", at.alias("valid_from"), F.lit(None).cast(state.schema["superseded_at"].dataType).alias("superseded_at"), F.lit(True).alias("is_active"))
    return ended.select(*begun.columns).unionByName(begun)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, by key; where both have one, non-null values of ``new`` win."""
    a, b = old.alias("a"), new.alias("b")
    cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = a.join(b, cond, "full_outer")
    return both.select(*[F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in new.columns else F.col(f"a.{c}").alias(c) for c in old.columns])


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose key it lacks, one a key."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def missing(wanted: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(there.select(*keys), keys, "left_anti")


def chunk_numbers(chunks: DataFrame) -> DataFrame:
    """``chunk_index`` from 0 within each source version."""
    order = Window.partitionBy("source_versions_id").orderBy("created_at", "document_key")
    return chunks.withColumn("chunk_index", (F.row_number().over(order) - 1).cast("long"))


def document_rows(sources: DataFrame) -> DataFrame:
    """Defaults of common documents: type from loader or source type, path from relative path or source, title from name."""
    kind = F.upper(F.coalesce(blank_to_null(F.col("loader")), blank_to_null(F.col("source_type")), F.lit("FILE")))
    path = F.coalesce(blank_to_null(F.col("relative_path")), blank_to_null(F.col("source")), F.lit(""))
    title = F.coalesce(blank_to_null(F.col("title")), F.col("source_name"))
    return sources.select("source_key", kind.alias("document_type"), path.alias("path"), title.alias("title"))


def consistency(versions: DataFrame, documents: DataFrame) -> DataFrame:
    """One row a collection: active versions, documents, and whether they agree."""
    v = versions.groupBy("collection_code").agg(F.count_if("is_active").alias("n_active"))
    d = documents.groupBy("collection_code").agg(F.count("*").alias("n_documents"))
    return v.join(d, "collection_code", "full_outer").select("collection_code", F.coalesce("n_active", F.lit(0)).alias("n_active"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.col("n_active").eqNullSafe(F.col("n_documents")).alias("agree"))


def group_source_hash(docs: DataFrame, files: DataFrame) -> DataFrame:
    """(source_key, source_hash) of sources whose pieces are ``docs`` (source_key, loader, row, item, place, content, metadata).

    A source that is a file in ``files`` (source_key, file_hash, config) hashes the file and the chunk configuration;
    rows of tables, items of lists and sources without a file hash their pieces, in order, each by its content and
    business metadata. Only hashes are gathered by source, never texts.
    """
    single = F.col("loader").isin("csv", "openpyxl") & F.col("row").isNotNull() | (F.col("loader") == "json") & F.col("item").isNotNull()
    piece = F.struct("place", chunk_hash(F.col("content"), F.col("metadata")).alias("h"))
    made = docs.withColumn("_single", F.coalesce(single, F.lit(False))).groupBy("source_key").agg(F.bool_or("_single").alias("single"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    by_file = F.when(~F.col("single"), F.sha2(F.concat_ws("|", "file_hash", "config"), 256))
    joined = made.join(files.select("source_key", "file_hash", "config"), "source_key", "left")
    by_piece = F.sha2(F.array_join(F.transform("pieces", lambda x: x["h"]), ""), 256)
    return joined.select("source_key", F.when(F.col("file_hash").isNotNull(), F.coalesce(by_file, by_piece)).otherwise(by_piece).alias("source_hash"))


def end_chunks(chunks: DataFrame, versions: DataFrame) -> DataFrame:
    """``chunks`` with is_active false where their source version is no longer active."""
    ended = versions.filter(~F.col("is_active")).select("source_versions_id", F.lit(True).alias("_ended")).distinct()
    return chunks.join(ended, "source_versions_id", "left").withColumn("is_active", F.col("is_active") & F.col("_ended").isNull()).drop("_ended")


def rebuild(state: DataFrame, collections: DataFrame, at: Column) -> DataFrame:
    """The state before a forced rebuild: all active versions of ``collections`` (collection_code) end."""
    hit = state.join(F.broadcast(collections.select("collection_code").distinct().withColumn("_hit", F.lit(True))), "collection_code", "left")
    ends = F.coalesce("_hit", F.lit(False)) & F.col("is_active")
    return hit.withColumn("superseded_at", F.when(ends, F.coalesce("superseded_at", at)).otherwise(F.col("superseded_at"))).withColumn("is_active", F.col("is_active") & ~ends).select(*state.columns)


def with_ids(versions: DataFrame, order: list[str], start: Column | int = 1) -> DataFrame:
    """New versions with ids that follow ``start``, in ``order``, without a single task."""
    from .sizes import numbered

    return numbered(versions, order, "source_versions_id", 0).withColumn("source_versions_id", F.col("source_versions_id") + start)


#: What one document is known by in the common table.
DOCUMENT = ["collections_id", "source_key", "source_hash", "document_version"]
#: What a sync writes of it.
FIELDS = ["source_versions_id", "source_type", "source_name", "source_path", "source_record_no", "title", "is_evaluation", "metadata"]


def common_documents(versions: DataFrame, collections: DataFrame, marked: DataFrame, namespace: str = "default") -> DataFrame:
    """The rows that source versions have in the common document table, from their ``metadata`` map; ``marked`` (source_key) are evaluation rows."""
    s = versions.join(F.broadcast(collections.select("collection_code", "collections_id")), "collection_code")
    s = s.join(marked.select("source_key", F.lit(True).alias("_marked")).distinct(), "source_key", "left")
    has = lambda k: blank_to_null(F.try_element_at("metadata", F.lit(k)))
    own = F.create_map(*[x for k, c in (("source_key", "source_key"), ("source_versions_id", "source_versions_id"), ("collection_code", "collection_code")) for x in (F.lit(k), F.col(c).cast("string"))], F.lit("namespace"), F.lit(namespace))
    kept = F.map_filter("metadata", lambda k, v: ~F.array_contains(F.map_keys(own), k))
    return s.select(
        *DOCUMENT, "is_active", "source_versions_id", F.upper(F.coalesce(has("loader"), has("source_type"), F.lit("FILE"))).alias("source_type"), "source_name",
        F.coalesce(has("relative_path"), has("source"), F.lit("")).alias("source_path"), regex_int(F.try_element_at("metadata", F.lit("row"))).alias("source_record_no"),
        F.coalesce(has("title"), F.col("source_name")).alias("title"), F.coalesce("_marked", F.lit(False)).alias("is_evaluation"), stable_json(F.map_concat(kept, own)).alias("metadata"),
    )


def sync_documents(documents: DataFrame, incoming: DataFrame) -> DataFrame:
    """The common table after a sync, with ``action``: ended, updated, inserted or kept.

    An active document ends where its source has another active version; then documents that ``incoming`` has too take
    its fields and state, and those that are missing are added. Hashes compare null-safe.
    """
    key = ["collections_id", "source_key"]
    active = incoming.filter("is_active")
    versions = active.groupBy(*key).agg(F.count("*").alias("_all"))
    same = active.groupBy(*[F.col(c).alias(f"_{c}") for c in DOCUMENT]).agg(F.count("*").alias("_same"))
    matches = lambda other: reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{other}{c}")) for c in DOCUMENT])
    old = documents.join(versions, key, "left").join(same, matches("_"), "left")
    ends = F.col("is_active") & (F.coalesce("_all", F.lit(0)) > F.coalesce("_same", F.lit(0)))
    old = old.withColumn("_ends", F.coalesce(ends, F.lit(False))).select(*DOCUMENT, "is_active", *FIELDS, "_ends")
    new = incoming.select(*[F.col(c).alias(f"n_{c}") for c in [*DOCUMENT, "is_active", *FIELDS]], F.lit(True).alias("_new"))
    both = old.withColumn("_old", F.lit(True)).join(new, matches("n_"), "full_outer")
    pick = lambda c: F.when(F.col("_new"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c)
    state = F.when(F.col("_new"), F.col("n_is_active")).otherwise(F.col("is_active") & ~F.col("_ends")).alias("is_active")
    action = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new"), "updated").when(F.col("_ends"), "ended").otherwise("kept")
    return both.select(*[pick(c) for c in DOCUMENT], state, *[pick(c) for c in FIELDS], action.alias("action"))


def _packed(hash_: Column) -> Column:
    """A string as bytes, one of 64 lower-case hexadecimal digits as the 32 that they stand for; the first byte tells which."""

    def pack(h: Column) -> Column:
        short = (F.length(h) == 64) & (F.lower(h) == h) & F.unhex(h).isNotNull()
        return F.when(short, F.concat(F.lit(b"\0"), F.unhex(h))).otherwise(F.concat(F.lit(b"\1"), h.cast("binary")))

    return F.element_at(F.transform(F.array(hash_), pack), 1)  # so that what the hash is made by runs once


def _unpacked(packed: Column) -> Column:
    own = F.substring(packed, 2, 1 << 30)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\0"), F.lower(F.hex(own))).otherwise(own.cast("string"))


def sync_chunks(existing: DataFrame, chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """The chunks to add to the common table: those of known documents that repeat no hash and no place, there or among themselves.

    A document is found by the version id in its JSON metadata; of new chunks with one hash the first by document and
    place is added. Chunks move twice, to be numbered and by their hash, with the columns that are wanted alone and hashes as
    bytes; the hashes that are there move beside them.
    """
    from .sizes import if_small

    with scope():  # else a filter of its JSON may be moved down to what the documents come from
        owner = materialize(documents.select("documents_id", F.get_json_object("metadata", "$.source_versions_id").alias("_version")), "owners", result=True)
    owned = F.col("source_versions_id").cast("string") == F.col("_version")
    has = lambda k: F.try_element_at("metadata", F.lit(k))
    new = chunks.select(
        "source_versions_id", "created_at", _packed(F.col("document_key")).alias("document_key"), _packed(F.col("chunk_hash")).alias("chunk_hash"), F.col("content").alias("chunk_text"),
        regex_int(has("page_number")).alias("page_number"), has("block_type").alias("block_type"), F.coalesce(blank_to_null(has("chunk_strategy")), F.lit("recursive")).alias("chunk_strategy"),
        regex_int(has("chunk_size"), F.lit(800), signed=False).alias("chunk_size"), regex_int(has("chunk_overlap"), F.lit(150), signed=False).alias("chunk_overlap"),
    )
    places = existing.select("documents_id", "chunk_index")
    if owner.limit(MOST_OWNERS + 1).count() <= MOST_OWNERS:
        owner = F.broadcast(owner)
        new = new.join(F.broadcast(owner.select("_version").distinct()), owned, "left_semi")
        places = places.join(F.broadcast(owner.select("documents_id").distinct()), "documents_id", "left_semi")
    new = new.repartition("source_versions_id").withColumn("document_key", _unpacked(F.col("document_key")))
    new = chunk_numbers(new).join(owner, owned).drop("source_versions_id", "created_at", "document_key", "_version")
    new = new.join(if_small(places, MOST_OWNERS), ["documents_id", "chunk_index"], "left_anti")
    # a hash that is there comes first among its own, and is no chunk to add
    there = existing.filter(F.col("chunk_hash").isNotNull()).select(_packed(F.col("chunk_hash")).alias("chunk_hash"))
    both = new.withColumn("_new", F.lit(1)).unionByName(there.withColumn("_new", F.lit(0)), allowMissingColumns=True).repartition("chunk_hash")
    first = F.row_number().over(Window.partitionBy("chunk_hash").orderBy("_new", "documents_id", "chunk_index"))
    return both.withColumn("_nth", first).filter("_nth = 1 and _new = 1").drop("_nth", "_new").withColumn("chunk_hash", _unpacked(F.col("chunk_hash")))


def to_sync(versions: DataFrame, documents: DataFrame, chunks: DataFrame, common_chunks: DataFrame) -> DataFrame:
    """One row: source versions without a document, chunks without a common one, and whether a sync can be left out."""
    d = missing(versions.select("source_versions_id"), documents, ["source_versions_id"]).agg(F.count("*").alias("n_documents"))
    c = missing(chunks.select("chunk_hash").distinct(), common_chunks, ["chunk_hash"]).agg(F.count("*").alias("n_chunks"))
    return d.join(F.broadcast(c)).withColumn("nothing_to_do", (F.col("n_documents") == 0) & (F.col("n_chunks") == 0))
