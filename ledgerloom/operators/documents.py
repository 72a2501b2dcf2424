"""Layered documents: context, parents, snapshots and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import (
    MAX_CONTEXT_BYTES,
    MAX_CONTEXT_DOCUMENTS,
    MAX_TITLE_BYTES,
    MAX_TITLE_CHARS,
)
from ledgerloom.functions import ident, routes, set_digest, text

# Documents are hashed per four-digit prefix of their key's hash first, so that
# no list of all documents is ever gathered.
SNAPSHOT_PREFIX = 4


def document_rules() -> dict[str, Column]:
    """Conditions every document row must meet."""
    route = F.col("route")
    return {
        "path": routes.is_canonical_path(route["path"]),
        "layer": route["layer"].isin(*routes.LAYERS),
        "sha256": F.col("sha256") == ident.sha256_hex(F.col("body")),
        "size": F.col("size") == F.octet_length("body"),
        "mtime_ns": F.col("mtime_ns") >= 0,
        "title": text.is_safe_text(F.col("title"), MAX_TITLE_BYTES, MAX_TITLE_CHARS, single_line=True),
    }


def document_violations(documents: DataFrame) -> DataFrame:
    broken = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
        for name, rule in document_rules().items()
    ]
    return documents.withColumn("rule", F.explode(F.array_compact(F.array(*broken))))


def orphans(documents: DataFrame, created: DataFrame | None = None) -> DataFrame:
    """Documents whose enclosing document exists neither now nor in ``created``.

    Only distinct parent keys meet the key list; a parent with very many
    children costs no more than one with a single child.
    """
    keys = documents.select("target_key")
    children = documents
    if created is not None:
        keys = keys.unionByName(created.select("target_key"))
        children = documents.select("target_key").unionByName(created.select("target_key"))
    children = children.withColumn("parent_key", routes.parent_key(F.col("target_key")))
    missing = (
        children.select("parent_key")
        .where(F.col("parent_key").isNotNull())
        .distinct()
        .join(keys.select(F.col("target_key").alias("parent_key")), "parent_key", "left_anti")
    )
    return children.join(missing, "parent_key", "left_semi").select("target_key", "parent_key")


def context_join(entries: DataFrame, bindings: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents bound to every entry, with what is wrong with a binding.

    ``entries`` holds (packet_sha256, entry_id), ``bindings`` (packet_sha256,
    entry_id, path), ``documents`` (packet_sha256, path, document_sha256) as
    read when the packet was frozen; a path read twice with different content
    is a conflict.
    """
    frozen = documents.groupBy("packet_sha256", "path").agg(
        F.min("document_sha256").alias("document_sha256"),
        (F.min("document_sha256") != F.max("document_sha256")).alias("conflict"),
    )
    problem = (
        F.when(F.col("path").isNull(), "no_document")
        .when(F.col("document_sha256").isNull(), "unknown_path")
        .when(F.col("conflict"), "conflict")
        .otherwise("ok")
    )
    return (
        entries.join(bindings.distinct(), ["packet_sha256", "entry_id"], "left")
        .join(frozen, ["packet_sha256", "path"], "left")
        .select("packet_sha256", "entry_id", "path", "document_sha256", problem.alias("outcome"))
    )


def context_snapshots(documents: DataFrame, bindings: DataFrame) -> DataFrame:
    """Per packet: size and hash of its frozen documents and bindings.

    A packet has at most a fixed number of documents and bytes. Only packets
    ``within_bounds`` are gathered and hashed; the others are reported without
    a hash. ``documents`` holds (packet_sha256, layer_number, path,
    document_sha256, size).
    """
    bounded = (F.col("documents") <= MAX_CONTEXT_DOCUMENTS) & (F.col("bytes") <= MAX_CONTEXT_BYTES)
    sizes = (
        documents.groupBy("packet_sha256")
        .agg(F.count("*").alias("documents"), F.sum("size").alias("bytes"))
        .withColumn("within_bounds", bounded)
    )
    accepted = sizes.where("within_bounds").select("packet_sha256")
    ordered = F.array_sort(F.collect_list(F.struct("layer_number", "path", "document_sha256")))
    docs = (
        documents.join(accepted, "packet_sha256", "left_semi")
        .groupBy("packet_sha256")
        .agg(F.to_json(ordered).alias("docs_json"))
    )
    routes_json = (
        bindings.join(accepted, "packet_sha256", "left_semi")
        .distinct()
        .groupBy("packet_sha256", "entry_id")
        .agg(F.array_sort(F.collect_set("path")).alias("paths"))
        .groupBy("packet_sha256")
        .agg(F.to_json(F.array_sort(F.collect_list(F.struct("entry_id", "paths")))).alias("routes_json"))
    )
    body = F.concat(F.col("docs_json"), F.lit("\n"), F.coalesce("routes_json", F.lit("[]")))
    return (
        sizes.join(docs, "packet_sha256", "left")
        .join(routes_json, "packet_sha256", "left")
        .withColumn("snapshot_sha256", ident.sha256_hex(body))
        .select("packet_sha256", "documents", "bytes", "snapshot_sha256", "within_bounds")
    )


def snapshot_hash(documents: DataFrame) -> DataFrame:
    """One row: number of documents and a hash of all keys and contents."""
    prefix = F.substring(ident.sha256_hex(F.col("target_key")), 1, SNAPSHOT_PREFIX)
    line = F.concat_ws(" ", "target_key", "sha256")
    parts = documents.groupBy(prefix.alias("prefix")).agg(
        F.count("*").alias("documents"),
        ident.sha256_hex(F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("part_sha256"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("prefix", "part_sha256")))
    joined = F.array_join(F.transform(ordered, lambda part: part["part_sha256"]), "\n")
    return parts.agg(
        F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
        ident.sha256_hex(joined).alias("snapshot_sha256"),
    )


def document_member(key: Column, sha256: Column) -> Column:
    """A document as a member of the snapshot's set."""
    return F.concat_ws(" ", key, sha256)


def snapshot_change(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """Sums (members, lanes) by which changes (target_key, sha256) move the snapshot's set digest.

    Only the changed documents are hashed: what they were is taken off, what they are is added.
    """
    old = documents.select("target_key", "sha256").join(
        changes.select("target_key"), "target_key", "left_semi"
    )
    moved = old.withColumn("leaves", F.lit(True)).unionByName(
        changes.select("target_key", "sha256").withColumn("leaves", F.lit(False))
    )
    return set_digest.summed(moved, [], document_member(F.col("target_key"), F.col("sha256")), F.col("leaves"))


def snapshot_digest(parts: DataFrame) -> DataFrame:
    """One row: number of documents and the set digest of all keys and contents, from stored sums."""
    whole = set_digest.combined(parts, [])
    return whole.select(
        F.coalesce("members", F.lit(0)).cast("bigint").alias("documents"),
        set_digest.digest(F.col("members"), F.col("lanes")).alias("snapshot_sha256"),
    )


def stale_snapshots(packets: DataFrame, documents: DataFrame) -> DataFrame:
    """Packets frozen against documents that have changed since."""
    current = snapshot_hash(documents).select("snapshot_sha256").scalar()
    return packets.withColumn("current_snapshot_sha256", current).where(
        F.col("frozen_snapshot_sha256") != F.col("current_snapshot_sha256")
    )


def wrong_preimages(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """Creates of stored documents, and replaces of documents that are not stored as expected.

    ``changes`` holds (target_key, action, expected_sha256); bodies are not read.
    """
    stored = documents.select("target_key", F.col("sha256").alias("stored_sha256"))
    wrong = F.when(F.col("action") == "create", F.col("stored_sha256").isNotNull()).otherwise(
        ~F.col("expected_sha256").eqNullSafe(F.col("stored_sha256"))
    )
    return (
        changes.select("target_key", "action", "expected_sha256")
        .join(stored, "target_key", "left")
        .where(wrong)
    )


def upsert(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """Document set after creates and replaces of whole bodies.

    ``documents`` holds (target_key, body, sha256), ``changes`` (target_key,
    body), both unique by key. Unchanged documents only pass an anti join on
    the key, so their bodies are shuffled only if the changes are large.
    """
    written = changes.select(
        "target_key", "body", ident.sha256_hex(F.col("body")).alias("sha256")
    )
    kept = documents.select("target_key", "body", "sha256").join(
        changes.select("target_key"), "target_key", "left_anti"
    )
    return kept.unionByName(written)


def casefold_collisions(paths: DataFrame, path: str = "path") -> DataFrame:
    """Groups of different paths that are equal ignoring case."""
    return (
        paths.select(text.casefold(F.col(path)).alias("folded"), F.col(path).alias("path"))
        .distinct()
        .groupBy("folded")
        .agg(F.count("*").alias("paths"), F.min("path").alias("first_path"))
        .where(F.col("paths") > 1)
    )
