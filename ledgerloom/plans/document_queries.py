"""Layered documents and document decisions over the sample documents and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import ident, routes
from ledgerloom.operators import decisions, documents
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import stored_once, table

SWEEP_DOCUMENTS = 20


def _leaf(doc_id: Column) -> Column:
    return F.concat(F.lit("doc-"), doc_id.cast("string"))


def sample_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The stored layered documents."""
    return stored_once("documents", spark, sf, lambda: _layered(spark, sf), texts=True)


def _layered(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as leaves, boards for branches with a good label, one tree per
    language but Spanish, and the root."""
    source = table(spark, sf, "documents")
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, layer: str, body: Column, **parts: Column) -> DataFrame:
        route = [parts.get(part, none).alias(part) for part in routes.PARTS]
        return df.select(F.lit(layer).alias("layer"), *route, body.alias("body"))

    tree, branch = F.col("lang"), F.col("source")
    good = table(spark, sf, "labels").where(F.col("quality") == 1).select("doc_id")
    boards = source.join(good, "doc_id", "left_semi").select("lang", "source").distinct()
    trees = source.select("lang").distinct().where(F.col("lang") != "es")
    root = source.agg(F.count("*").alias("n"))
    everything = (
        rows(source, "stm", F.col("text"), tree=tree, branch=branch, leaf=_leaf(F.col("doc_id")))
        .unionByName(rows(boards, "mtm", F.concat(F.lit("Board of "), tree, F.lit("/"), branch), tree=tree, branch=branch))
        .unionByName(rows(trees, "ltm", F.concat(F.lit("Tree of "), tree), tree=tree))
        .unionByName(rows(root, "xltm", F.concat(F.lit("Forest of "), F.col("n").cast("string"))))
    )
    route = [F.col(part) for part in routes.PARTS]
    return everything.select(
        "*",
        routes.route_key(F.col("layer"), *route).alias("target_key"),
        F.concat(F.concat_ws("/", "layer", *route), F.lit(".md")).alias("path"),
        ident.sha256_hex(F.col("body")).alias("sha256"),
    )


DOCS_SQL = """
good AS (SELECT doc_id FROM labels WHERE quality = 1),
docs AS (
  SELECT 'stm' AS layer, lang AS tree, source AS branch, 'doc-' || doc_id AS leaf, text AS body,
    'stm/' || lang || '/' || source || '/doc-' || doc_id AS target_key,
    'stm/' || lang || '/' || source || '/doc-' || doc_id || '.md' AS path, sha256(text) AS sha256 FROM documents
  UNION ALL SELECT DISTINCT 'mtm', lang, source, NULL, 'Board of ' || lang || '/' || source,
    'mtm/' || lang || '/' || source || '/', 'mtm/' || lang || '/' || source || '.md',
    sha256('Board of ' || lang || '/' || source) FROM documents WHERE doc_id IN (SELECT doc_id FROM good)
  UNION ALL SELECT DISTINCT 'ltm', lang, NULL, NULL, 'Tree of ' || lang, 'ltm/' || lang || '//',
    'ltm/' || lang || '.md', sha256('Tree of ' || lang) FROM documents WHERE lang <> 'es'
  UNION ALL SELECT 'xltm', NULL, NULL, NULL, 'Forest of ' || count(*), 'xltm///', 'xltm.md',
    sha256('Forest of ' || count(*)) FROM documents)
"""

_SNAPSHOT = """
SELECT CAST(sum(n) AS BIGINT) AS documents, sha256(string_agg(part, chr(10) ORDER BY prefix)) AS snapshot_sha256
FROM (SELECT left(sha256(target_key), 4) AS prefix, count(*) AS n,
        sha256(string_agg(target_key || ' ' || sha256, chr(10) ORDER BY target_key || ' ' || sha256)) AS part
      FROM docs GROUP BY 1)
"""


@query(
    "target_key",
    o.with_(
        DOCS_SQL,
        """SELECT target_key, layer <> 'stm' OR leaf <> 'doc-0' AS valid,
           CASE WHEN layer = 'mtm' THEN target_key ELSE layer || '/' || coalesce(tree, '') || '/' || coalesce(branch, '')
             || '/' || coalesce(leaf, '') END AS key, coalesce(regexp_full_match(branch, '[a-z0-9-]+'), false)
             AND tree <> 'de' AS mtm_valid FROM docs""",
    ),
)
def target_key(spark: SparkSession, sf: str) -> DataFrame:
    """Target checks of every route, as it is and forced into a board's shape."""
    docs = sample_documents(spark, sf)
    leaf = F.when(F.col("leaf") == "doc-0", F.upper("leaf")).otherwise(F.col("leaf"))
    own = F.struct("layer", "tree", "branch", leaf.alias("leaf"))
    extra = F.when(F.col("tree") == "de", F.lit("x"))
    board = F.struct(F.lit("mtm").alias("layer"), "tree", "branch", extra.alias("leaf"))
    return docs.select(
        "target_key",
        routes.is_valid_target(own).alias("valid"),
        routes.target_key(F.struct("layer", "tree", "branch", "leaf")).alias("key"),
        routes.is_valid_target(board).alias("mtm_valid"),
    )


@query(
    "orphan_documents",
    o.with_(
        DOCS_SQL,
        """SELECT target_key, parent_key FROM (SELECT target_key, CASE layer
             WHEN 'stm' THEN 'mtm/' || tree || '/' || branch || '/' WHEN 'mtm' THEN 'ltm/' || tree || '//'
             WHEN 'ltm' THEN 'xltm///' END AS parent_key FROM docs)
           WHERE parent_key IS NOT NULL AND parent_key NOT IN (SELECT target_key FROM docs)""",
    ),
)
def orphan_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents.orphans(sample_documents(spark, sf))


@query("snapshot_hash", o.with_(DOCS_SQL, _SNAPSHOT))
def snapshot_hash(spark: SparkSession, sf: str) -> DataFrame:
    return documents.snapshot_hash(sample_documents(spark, sf))


@query(
    "snapshot_freshness",
    o.with_(
        DOCS_SQL,
        f"""SELECT DISTINCT source AS packet_sha256, snapshot_sha256 AS current_snapshot_sha256
            FROM documents, ({_SNAPSHOT}) WHERE lang <> 'en'
            AND source NOT IN (SELECT source FROM documents WHERE lang = 'en')
            UNION SELECT DISTINCT source || '-' || lang, snapshot_sha256 FROM documents, ({_SNAPSHOT}) WHERE lang = 'de'""",
    ),
)
def snapshot_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Packets per source frozen on the current documents, and per German source frozen before."""
    docs = sample_documents(spark, sf)
    source = table(spark, sf, "documents")
    current = documents.snapshot_hash(docs).select("snapshot_sha256").scalar()
    fresh = source.select(F.col("source").alias("packet_sha256")).distinct().withColumn(
        "frozen_snapshot_sha256", current
    )
    older = (
        source.where(F.col("lang") == "de")
        .select(F.concat_ws("-", "source", "lang").alias("packet_sha256"))
        .distinct()
        .withColumn("frozen_snapshot_sha256", ident.sha256_hex(F.col("packet_sha256")))
    )
    stale = documents.stale_snapshots(fresh.unionByName(older), docs)
    return stale.select("packet_sha256", "current_snapshot_sha256")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as entries of sweeps of at most 20 documents."""
    number = F.expr(f"doc_id div {SWEEP_DOCUMENTS}").cast("string")
    # The hash is taken before the join, so that who needs no more of the text does not send it.
    hashed = table(spark, sf, "documents").withColumn("text_sha256", F.sha2("text", 256))
    return hashed.join(table(spark, sf, "labels"), "doc_id").select(
        "*",
        ident.sha256_hex(F.concat(F.lit("sweep-"), number)).alias("packet_sha256"),
        ident.sha256_hex(F.concat(F.lit("entry-"), F.col("doc_id").cast("string"))).alias("entry_id"),
    )


def sweep_context(spark: SparkSession, sf: str) -> DataFrame:
    """The stored frozen documents of every sweep."""
    return stored_once("sweep_context", spark, sf, lambda: _frozen_context(spark, sf))


def _frozen_context(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of every sweep: its leaves and their boards."""
    number = F.expr(f"doc_id div {SWEEP_DOCUMENTS}").cast("string")
    members = table(spark, sf, "documents").select(
        ident.sha256_hex(F.concat(F.lit("sweep-"), number)).alias("packet_sha256"),
        "lang", "source", "doc_id", "n_chars",
    )
    # Straight from the tables: of the bodies only hashes and sizes are sent and stored.
    docs = _layered(spark, sf).select(
        "target_key", "path", F.col("sha256").alias("document_sha256"), F.octet_length("body").cast("bigint").alias("size"),
        "layer",
    )
    leaf = F.concat_ws("/", F.lit("stm"), "lang", "source", _leaf(F.col("doc_id")))
    board = F.concat(F.lit("mtm/"), "lang", F.lit("/"), "source", F.lit("/"))
    wanted = members.select("packet_sha256", leaf.alias("target_key")).unionByName(
        members.select("packet_sha256", board.alias("target_key")).distinct()
    )
    return wanted.join(docs, "target_key")


def _target(layer: str, with_leaf: bool) -> Column:
    leaf = _leaf(F.col("doc_id")) if with_leaf else F.lit(None).cast("string")
    return F.struct(
        F.lit(layer).alias("layer"), F.col("lang").alias("tree"), F.col("source").alias("branch"), leaf.alias("leaf")
    )


def sweep_changes(spark: SparkSession, sf: str, bodies: bool = False) -> DataFrame:
    """The stored changes of every sweep; ``bodies`` are stored only for those who read them."""
    if bodies:
        return stored_once("sweep_changes", spark, sf, lambda: _decided(spark, sf)[1], texts=True)
    return stored_once("sweep_change_heads", spark, sf, lambda: _decided(spark, sf)[1].drop("body"))


def sweep_dispositions(spark: SparkSession, sf: str) -> DataFrame:
    """The stored dispositions of every sweep."""
    return stored_once("sweep_dispositions", spark, sf, lambda: _decided(spark, sf)[2])


def sweep_decisions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored items, changes with their bodies, and dispositions of every sweep."""
    items = stored_once("sweep_items", spark, sf, lambda: _decided(spark, sf)[0])
    return items, sweep_changes(spark, sf, bodies=True), sweep_dispositions(spark, sf)


def _decided(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, changes and dispositions of every sweep, with faults by language and length."""
    entries = labelled(spark, sf)
    items = entries.select("packet_sha256", F.col("entry_id").alias("item_id"))
    clean = F.col("toxic") == 0
    status = (
        F.when(~clean, "source_only")
        .when(F.col("quality") == 0, "already_covered")
        .when(F.col("n_chars") > 5_000, "promotion_debt")
        .otherwise("promoted")
    )
    leaf, board = _target("stm", True), _target("mtm", False)
    nothing = F.array().cast("array<struct<layer:string,tree:string,branch:string,leaf:string>>")
    targets = (
        F.when(F.col("status") == "source_only", F.when(F.col("quality") == 1, F.array(leaf)).otherwise(nothing))
        .when(F.col("status") == "already_covered", F.array(board))
        .when((F.col("status") == "promoted") & (F.col("lang") == "fr"), F.array(board))
        .otherwise(F.array(leaf, board))
    )
    decided = entries.withColumn("status", status)
    forgotten = (F.col("status") == "already_covered") & (F.col("n_chars") < 1_000)
    dispositions = decided.where(~forgotten).select(
        "packet_sha256",
        "entry_id",
        "status",
        targets.alias("targets"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("reason"),
    )
    creates = F.col("lang") == "es"
    changes = decided.where(F.col("status") == "promoted").select(
        "packet_sha256",
        F.col("doc_id").alias("change_no"),
        F.when(creates, "create").otherwise("replace").alias("action"),
        leaf.alias("target"),
        F.when(creates, F.lit(None).cast("string"))
        .when(F.col("lang") == "de", F.sha2(F.concat(F.lit("old-"), F.col("doc_id").cast("string")), 256))
        .otherwise(F.col("text_sha256"))
        .alias("expected_sha256"),
        F.col("text").alias("body"),
        F.array("entry_id").alias("source_entry_ids"),
        F.lit("labelled good").alias("reason"),
        F.when(F.col("n_chars") < 100, "certain").otherwise("high").alias("confidence"),
    )
    return items, changes, dispositions


_SWEEP = DOCS_SQL + """,
labelled AS (SELECT d.*, quality, toxic, sha256('sweep-' || (doc_id // 20)) AS packet_sha256,
    sha256('entry-' || doc_id) AS entry_id, 'stm/' || lang || '/' || source || '/doc-' || doc_id AS leaf_key,
    'mtm/' || lang || '/' || source || '/' AS board_key,
    CASE WHEN toxic <> 0 THEN 'source_only' WHEN quality = 0 THEN 'already_covered'
         WHEN n_chars > 5000 THEN 'promotion_debt' ELSE 'promoted' END AS status
  FROM documents d JOIN labels USING (doc_id)),
disposed AS (SELECT *, CASE WHEN status = 'source_only' THEN quality WHEN status = 'already_covered' THEN 1
    WHEN status = 'promoted' AND lang = 'fr' THEN 1 ELSE 2 END AS targets
  FROM labelled WHERE NOT (status = 'already_covered' AND n_chars < 1000)),
outcomes AS (SELECT packet_sha256, entry_id, status, targets,
    CASE WHEN status = 'source_only' AND targets > 0 THEN 'unexpected_targets'
         WHEN status = 'already_covered' AND board_key NOT IN (SELECT target_key FROM docs) THEN 'not_in_context'
         WHEN status = 'promoted' AND lang = 'fr' THEN 'not_changed' ELSE 'ok' END AS outcome FROM disposed),
changed AS (SELECT * FROM labelled WHERE status = 'promoted'),
preimages AS (SELECT packet_sha256, doc_id AS change_no, leaf_key AS target_key,
    CASE lang WHEN 'es' THEN 'create_conflict' WHEN 'de' THEN 'preimage_mismatch' ELSE 'ok' END AS status FROM changed)
"""


@query(
    "preimage_check",
    o.with_(_SWEEP, "SELECT packet_sha256, change_no, target_key, status FROM preimages"),
)
def preimage_check(spark: SparkSession, sf: str) -> DataFrame:
    checked = decisions.preimage_check(sweep_changes(spark, sf), sweep_context(spark, sf))
    return checked.select("packet_sha256", "change_no", "target_key", "status")


@query(
    "change_source_check",
    o.with_(
        _SWEEP,
        "SELECT packet_sha256, leaf_key AS target_key, entry_id FROM changed WHERE lang = 'fr'",
    ),
)
def change_source_check(spark: SparkSession, sf: str) -> DataFrame:
    return decisions.unmatched_change_sources(sweep_changes(spark, sf), sweep_dispositions(spark, sf))


@query(
    "disposition_check",
    o.with_(
        _SWEEP,
        "SELECT packet_sha256, entry_id, status, CAST(targets AS BIGINT) AS targets, outcome FROM outcomes",
    ),
)
def disposition_check(spark: SparkSession, sf: str) -> DataFrame:
    changes, dispositions = sweep_changes(spark, sf), sweep_dispositions(spark, sf)
    checked = decisions.disposition_check(dispositions, changes, sweep_context(spark, sf))
    return checked.withColumn("targets", F.col("targets").cast("bigint"))


_BODY_OK = f"""{o.strip('text')} <> '' AND nfc_normalize(text) = text AND strlen(text) <= 65536
  AND NOT regexp_matches(text, '{o.FORBIDDEN}')"""


@query(
    "validate_structured",
    o.with_(
        _SWEEP,
        f"""SELECT packet_sha256, 'change_' || status AS rule, target_key AS subject FROM preimages WHERE status <> 'ok'
            UNION ALL SELECT packet_sha256, 'change_body', doc_id::VARCHAR FROM changed WHERE NOT ({_BODY_OK})
            UNION ALL SELECT packet_sha256, 'change_confidence', doc_id::VARCHAR FROM changed WHERE n_chars < 100
            UNION ALL SELECT packet_sha256, 'change_source_unmatched', leaf_key || ' ' || entry_id FROM changed WHERE lang = 'fr'
            UNION ALL SELECT packet_sha256, 'disposition_' || outcome, entry_id FROM outcomes WHERE outcome <> 'ok'
            UNION ALL SELECT packet_sha256, 'coverage_missing', entry_id FROM labelled
              WHERE status = 'already_covered' AND n_chars < 1000""",
    ),
)
def validate_structured(spark: SparkSession, sf: str) -> DataFrame:
    items, changes, dispositions = sweep_decisions(spark, sf)
    return decisions.validate_structured(items, sweep_context(spark, sf), changes, dispositions)


_BINDINGS = _SWEEP + """,
bindings AS (
  SELECT packet_sha256, entry_id, 'stm/' || lang || '/' || source || '/doc-' || doc_id || '.md' AS path, n_chars
  FROM labelled WHERE lang <> 'es'
  UNION ALL SELECT packet_sha256, entry_id, 'mtm/' || lang || '/' || source || '.md', 0 FROM labelled WHERE lang <> 'es')
"""


def _bindings(entries: DataFrame) -> DataFrame:
    """Every entry is bound to its leaf and board; Spanish entries are bound to nothing."""
    bound = entries.where(F.col("lang") != "es")
    leaf = F.concat_ws("/", F.lit("stm"), "lang", "source", _leaf(F.col("doc_id")))
    board = F.concat_ws("/", F.lit("mtm"), "lang", "source")
    return bound.select(
        "packet_sha256", "entry_id", F.explode(F.array(leaf, board)).alias("key")
    ).select("packet_sha256", "entry_id", F.concat("key", F.lit(".md")).alias("path"))


@query(
    "context_join",
    o.with_(
        _BINDINGS,
        """SELECT packet_sha256, entry_id, path,
             CASE WHEN n_chars > 5000 THEN least(sha256, sha256(sha256)) ELSE sha256 END AS document_sha256,
             CASE WHEN sha256 IS NULL THEN 'unknown_path' WHEN n_chars > 5000 THEN 'conflict' ELSE 'ok' END AS outcome
           FROM bindings LEFT JOIN docs USING (path)
           UNION ALL SELECT packet_sha256, entry_id, NULL, NULL, 'no_document' FROM labelled WHERE lang = 'es'""",
    ),
)
def context_join(spark: SparkSession, sf: str) -> DataFrame:
    """Bindings of entries to documents as read; long leaves were read twice and differ."""
    entries = labelled(spark, sf)
    read = sweep_context(spark, sf).select("packet_sha256", "path", "document_sha256", "target_key")
    long_leaves = table(spark, sf, "documents").where(F.col("n_chars") > 5_000).select(
        F.concat_ws("/", F.lit("stm"), "lang", "source", _leaf(F.col("doc_id"))).alias("target_key")
    )
    again = read.join(long_leaves, "target_key", "left_semi").withColumn(
        "document_sha256", F.sha2("document_sha256", 256)
    )
    return documents.context_join(
        entries.select("packet_sha256", "entry_id"), _bindings(entries), read.unionByName(again)
    )


@query(
    "context_snapshot",
    o.with_(
        _BINDINGS,
        """SELECT d.packet_sha256, d.documents, d.bytes, d.documents <= 96 AND d.bytes <= 160000 AS within_bounds,
             CASE WHEN d.documents <= 96 AND d.bytes <= 160000 THEN
               sha256(docs_json || chr(10) || coalesce(routes_json, '[]')) END AS snapshot_sha256
           FROM (SELECT packet_sha256, count(*) AS documents, CAST(sum(strlen(body)) AS BIGINT) AS bytes,
               '[' || string_agg('{"layer_number":' || CASE layer WHEN 'stm' THEN 4 ELSE 3 END || ',"path":"' || path
                 || '","document_sha256":"' || sha256 || '"}', ',' ORDER BY layer = 'stm', path) || ']' AS docs_json
             FROM (SELECT sha256('sweep-' || (doc_id // 20)) AS packet_sha256, 'stm/' || lang || '/' || source || '/doc-' || doc_id AS k
                   FROM documents UNION SELECT sha256('sweep-' || (doc_id // 20)), 'mtm/' || lang || '/' || source || '/' FROM documents) w
             JOIN docs ON target_key = k GROUP BY 1) d
           LEFT JOIN (SELECT packet_sha256, '[' || string_agg('{"entry_id":"' || entry_id || '","paths":["' || paths || '"]}',
                 ',' ORDER BY entry_id) || ']' AS routes_json
               FROM (SELECT packet_sha256, entry_id, string_agg(path, '","' ORDER BY path) AS paths FROM bindings GROUP BY ALL)
               GROUP BY 1) r USING (packet_sha256)""",
    ),
)
def context_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Size and hash of every sweep's frozen documents and bindings."""
    numbers = F.create_map(*[F.lit(v) for pair in routes.LAYER_NUMBERS.items() for v in pair])
    frozen = sweep_context(spark, sf).withColumn("layer_number", numbers[F.col("layer")])
    return documents.context_snapshots(frozen, _bindings(labelled(spark, sf)))


@query(
    "document_upsert",
    o.with_(
        _SWEEP,
        """SELECT target_key, sha256, CAST(strlen(body) AS BIGINT) AS bytes FROM docs
             WHERE target_key NOT IN (SELECT leaf_key FROM changed WHERE lang IN ('en', 'fr'))
           UNION ALL SELECT leaf_key, sha256('Reviewed. ' || text), CAST(strlen('Reviewed. ' || text) AS BIGINT)
             FROM changed WHERE lang IN ('en', 'fr')
           UNION ALL SELECT DISTINCT board_key, sha256('New board'), CAST(9 AS BIGINT) FROM labelled
             WHERE board_key NOT IN (SELECT target_key FROM docs)""",
    ),
)
def document_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Reviewed bodies of English and French leaves and boards that were missing."""
    docs = sample_documents(spark, sf).select("target_key", "body", "sha256")
    changes = sweep_changes(spark, sf, bodies=True)
    reviewed = changes.where(F.col("target.tree").isin("en", "fr")).select(
        routes.target_key(F.col("target")).alias("target_key"), F.concat(F.lit("Reviewed. "), "body").alias("body")
    )
    missing = (
        labelled(spark, sf)
        .select(F.concat(F.lit("mtm/"), "lang", F.lit("/"), "source", F.lit("/")).alias("target_key"))
        .distinct()
        .join(docs.select("target_key"), "target_key", "left_anti")
        .withColumn("body", F.lit("New board"))
    )
    after = documents.upsert(docs, reviewed.unionByName(missing))
    return after.select("target_key", "sha256", F.octet_length("body").cast("bigint").alias("bytes"))
