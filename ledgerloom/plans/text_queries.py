"""Predicates and scalar functions over documents, events and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import events, hygiene, ident, routes, text, times
from ledgerloom.functions.once import with_once
from ledgerloom.operators import documents as docs
from ledgerloom.operators.packets import packet_text
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import ZONE, iso_utc, table


def _sha(value: Column, name: str) -> Column:
    return ident.sha256_hex(value).alias(name)


@query(
    "bounded_text",
    f"""SELECT doc_id, CAST(length(b) AS BIGINT) AS chars, sha256(b) AS text_sha256,
        b LIKE '%[truncated locally]' AS cut
        FROM (SELECT doc_id, {o.bounded('text')} AS b FROM documents)""",
)
def bounded_text(spark: SparkSession, sf: str) -> DataFrame:
    bounded = with_once(table(spark, sf, "documents").select("doc_id", "text"), b=text.bounded_text(F.col("text")))
    return bounded.select(
        "doc_id",
        F.char_length("b").cast("bigint").alias("chars"),
        _sha(F.col("b"), "text_sha256"),
        F.endswith("b", F.lit("[truncated locally]")).alias("cut"),
    )


@query(
    "utf8_truncate",
    f"""SELECT doc_id, {o.truncated('text', 1200)} AS t1200, {o.truncated('text', 101)} AS t101,
        {o.truncated('text', 2)} AS t2 FROM documents""",
)
def utf8_truncate(spark: SparkSession, sf: str) -> DataFrame:
    cuts = [text.truncate_utf8(F.col("text"), size).alias(f"t{size}") for size in (1200, 101, 2)]
    return table(spark, sf, "documents").select("doc_id", *cuts)


@query(
    "markdown_excerpt",
    f"""SELECT doc_id, {o.truncated('line1', 480)} AS excerpt, sha256(inert) AS inert_sha256
        FROM (SELECT doc_id, {o.escaped_line('text')} AS line1,
                     {o.escaped(o.one_line(f"regexp_replace(nfc_normalize(text), '{o.FORBIDDEN}', '', 'g')"))} AS inert
              FROM documents)""",
)
def markdown_excerpt(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        text.excerpt(F.col("text"), 480).alias("excerpt"),
        _sha(text.inert_markdown(F.col("text")), "inert_sha256"),
    )


@query(
    "packet_text",
    f"""SELECT doc_id, {o.truncated('text', 1200)} AS packet_text, strlen(text) > 1200 AS truncated,
        sha256(text) AS source_text_sha256 FROM documents""",
)
def packet_text_query(spark: SparkSession, sf: str) -> DataFrame:
    bounded = with_once(table(spark, sf, "documents").select("doc_id", "text"), p=packet_text(F.col("text"), 1200))
    return bounded.select(
        "doc_id",
        F.col("p.text").alias("packet_text"),
        F.col("p.truncated").alias("truncated"),
        _sha(F.col("text"), "source_text_sha256"),
    )


_SAFE = f"""{o.strip('text')} <> '' AND nfc_normalize(text) = text
  AND NOT regexp_matches(text, '{o.FORBIDDEN}')"""


@query(
    "safe_text_check",
    f"""SELECT doc_id, ({_SAFE} AND strlen(text) <= 65536) AS body_ok,
        ({_SAFE} AND strlen(text) <= 4800 AND length(text) <= 1200
         AND NOT regexp_matches(text, '[\\n\\r\\t]')) AS line_ok,
        (nfc_normalize(decomposed) = decomposed) AS decomposed_is_nfc
        FROM (SELECT *, replace(text, chr(233), 'e' || chr(769)) AS decomposed FROM documents)""",
)
def safe_text_check(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.is_safe_text(body, 65_536).alias("body_ok"),
        text.is_safe_text(body, 4_800, 1_200, single_line=True).alias("line_ok"),
        text.is_nfc(F.replace(body, F.lit("\u00e9"), F.lit("e\u0301"))).alias("decomposed_is_nfc"),
    )


@query(
    "identifier_check",
    """SELECT doc_id, regexp_full_match(CASE doc_id % 3 WHEN 0 THEN sha256(text) WHEN 1 THEN left(sha256(text), 63)
         ELSE upper(sha256(text)) END, '[0-9a-f]{64}') AS sha_is_hex64,
       regexp_full_match(CASE WHEN doc_id % 4 = 0 THEN md5(text) || '0' ELSE md5(text) END, '[0-9a-f]{32}') AS md5_is_hex32,
       regexp_full_match(word, '[a-z0-9](?:[a-z0-9-]{0,62}[a-z0-9])?') AS word_is_slug,
       regexp_full_match(word, '[A-Za-z0-9][A-Za-z0-9._:/-]{0,99}') AS word_is_model,
       word IN ('low', 'medium', 'high', 'xhigh', 'max', 'ultra') AS word_is_effort
       FROM (SELECT *, CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'High' ELSE split_part(text, ' ', 2) END AS word
             FROM documents)""",
)
def identifier_check(spark: SparkSession, sf: str) -> DataFrame:
    """Words and hashes of documents, some cut, lengthened or in capitals, against the identifier forms."""
    number = F.col("doc_id")
    second = F.split_part("text", F.lit(" "), F.lit(2))
    word = F.when(number % 5 == 0, "high").when(number % 5 == 1, "High").otherwise(second)
    sha = ident.sha256_hex(F.col("text"))
    shaped = F.when(number % 3 == 0, sha).when(number % 3 == 1, F.left(sha, F.lit(63))).otherwise(F.upper(sha))
    md5 = F.when(number % 4 == 0, F.concat(F.md5("text"), F.lit("0"))).otherwise(F.md5("text"))
    return table(spark, sf, "documents").select(
        "doc_id",
        ident.is_hex64(shaped).alias("sha_is_hex64"),
        ident.is_hex32(md5).alias("md5_is_hex32"),
        ident.is_slug(word).alias("word_is_slug"),
        ident.is_model_id(word).alias("word_is_model"),
        ident.is_effort(word).alias("word_is_effort"),
    )


# The check's own statement of the patterns.
_PRIVATE_SQL = {
    "mac_home_path": r"/Users/[A-Za-z0-9_.-]+/",
    "linux_home_path": r"/home/[A-Za-z0-9_.-]+/",
    "secret_key": r"sk-[A-Za-z0-9]{16,}",
    "uuid": r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b",
}
_PATTERN_UNION = " UNION ALL ".join(
    f"SELECT origin, '{name}' AS pattern, count(*) FILTER (WHERE regexp_matches(body, '{pattern}')) AS hits, "
    f"count(*) FILTER (WHERE first = '{name}') AS findings FROM found GROUP BY origin"
    for name, pattern in _PRIVATE_SQL.items()
)
_FIRST = " ".join(f"WHEN regexp_matches(body, '{pattern}') THEN '{name}'" for name, pattern in _PRIVATE_SQL.items())


@query(
    "private_data_scan",
    f"""WITH texts AS (SELECT 'documents' AS origin, text AS body FROM documents UNION ALL
        SELECT 'pages', html FROM pages UNION ALL SELECT 'conversations', text FROM conversations
        UNION ALL SELECT 'made', CASE page_id % 6
          WHEN 0 THEN '/home/' || regexp_extract(url, '^https?://(.*)$', 1) || '/x'
          WHEN 1 THEN '/Users/me/' || url WHEN 2 THEN 'key sk-' || md5(url) WHEN 3 THEN 'sk-' || left(md5(url), 15)
          WHEN 4 THEN 'id ' || regexp_replace(upper(md5(url)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')
          ELSE '/home/a/ and /Users/b/ and sk-' || md5(url) END FROM pages),
        found AS (SELECT *, CASE {_FIRST} END AS first FROM texts)
        {_PATTERN_UNION}""",
)
def private_data_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Hits per pattern, and findings when a text counts once, by its first pattern."""

    def texts(name: str, column: Column, origin: str | None = None) -> DataFrame:
        return table(spark, sf, name).select(F.lit(origin or name).alias("origin"), column.alias("body"))

    kind, url = F.col("page_id") % 6, F.col("url")
    dashed = F.regexp_replace(F.upper(F.md5(url)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    made = (
        F.when(kind == 0, F.concat(F.lit("/home/"), F.regexp_extract("url", r"^https?://(.*)$", 1), F.lit("/x")))
        .when(kind == 1, F.concat(F.lit("/Users/me/"), url))
        .when(kind == 2, F.concat(F.lit("key sk-"), F.md5(url)))
        .when(kind == 3, F.concat(F.lit("sk-"), F.left(F.md5(url), F.lit(15))))
        .when(kind == 4, F.concat(F.lit("id "), dashed))
        .otherwise(F.concat(F.lit("/home/a/ and /Users/b/ and sk-"), F.md5(url)))
    )
    everything = (
        texts("documents", F.col("text"))
        .unionByName(texts("pages", F.col("html")))
        .unionByName(texts("conversations", F.col("text")))
        .unionByName(texts("pages", made, "made"))
    )
    flags = hygiene.private_pattern_hits(F.col("body"))
    found = with_once(everything, **flags)
    found = found.withColumn("first", hygiene.first_hit({name: F.col(name) for name in flags}))
    rows = [
        F.struct(
            F.lit(name).alias("pattern"),
            F.count_if(F.col(name)).alias("hits"),
            F.count_if(F.col("first") == name).alias("findings"),
        )
        for name in flags
    ]
    return found.groupBy("origin").agg(F.array(*rows).alias("rows")).select("origin", F.inline("rows"))


_PATHS_SQL = """
paths AS (
  SELECT 'page-' || page_id AS id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages
  UNION ALL
  SELECT 'doc-' || doc_id, CASE lang WHEN 'fr' THEN 'handoffs/' || source || '.md'
    WHEN 'de' THEN source || '/' || doc_id || '.packet.json' WHEN 'es' THEN source || '/state.json'
    ELSE source || '/doc-' || doc_id || '.md' END FROM documents
  UNION ALL SELECT 'url-' || page_id, url FROM pages
  UNION ALL SELECT 'up-' || doc_id, source || '/../' || lang FROM documents)
"""


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    pages, documents = table(spark, sf, "pages"), table(spark, sf, "documents")
    number = F.col("doc_id").cast("string")
    by_language = (
        F.when(F.col("lang") == "fr", F.concat(F.lit("handoffs/"), "source", F.lit(".md")))
        .when(F.col("lang") == "de", F.concat("source", F.lit("/"), number, F.lit(".packet.json")))
        .when(F.col("lang") == "es", F.concat("source", F.lit("/state.json")))
        .otherwise(F.concat("source", F.lit("/doc-"), number, F.lit(".md")))
    )

    def rows(df: DataFrame, prefix: str, key: str, path: Column) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), path.alias("path"))

    return (
        rows(pages, "page-", "page_id", F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1))
        .unionByName(rows(documents, "doc-", "doc_id", by_language))
        .unionByName(rows(pages, "url-", "page_id", F.col("url")))
        .unionByName(rows(documents, "up-", "doc_id", F.concat("source", F.lit("/../"), "lang")))
    )


@query(
    "artifact_name_filter",
    o.with_(
        _PATHS_SQL,
        """SELECT id, path FROM paths WHERE
           split_part(path, '/', -1) IN ('model-state.json', 'state.json', 'ledger.jsonl')
           OR path LIKE '%.packet.json' OR path LIKE '%.result.json'
           OR split_part(path, '/', 1) IN ('handoffs', 'model-daily', 'structured')""",
    ),
)
def artifact_name_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).where(hygiene.is_private_artifact(F.col("path")))


@query(
    "canonical_path_check",
    o.with_(
        _PATHS_SQL,
        """SELECT id, path <> '' AND strlen(path) <= 1024 AND nfc_normalize(path) = path
           AND NOT regexp_matches(path, '[\\\\\\x00-\\x1f\\x7f]')
           AND len(list_filter(string_split(path, '/'), lambda p: p IN ('', '.', '..'))) = 0 AS canonical
           FROM paths""",
    ),
)
def canonical_path_check(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).select("id", routes.is_canonical_path(F.col("path")).alias("canonical"))


@query(
    "casefold_collisions",
    """WITH paths AS (SELECT DISTINCT source || '/' || split_part(text, ' ', 1) AS path FROM documents
         UNION SELECT source || '/' || lower(split_part(text, ' ', 1)) FROM documents)
       SELECT count(DISTINCT path) AS paths, min(path) AS first_path
       FROM paths GROUP BY lower(path) HAVING count(DISTINCT path) > 1""",
)
def casefold_collisions(spark: SparkSession, sf: str) -> DataFrame:
    word = F.split_part("text", F.lit(" "), F.lit(1))
    documents = table(spark, sf, "documents")
    paths = documents.select(F.concat_ws("/", "source", word).alias("path")).unionByName(
        documents.select(F.concat_ws("/", "source", F.lower(word)).alias("path"))
    )
    return docs.casefold_collisions(paths).select("paths", "first_path")


def _shaped_props(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as lines, malformed in one way per event type."""
    props = F.col("props")
    shaped = (
        F.when(F.col("event_type") == "click", F.concat(props, F.lit(" x")))
        .when(F.col("event_type") == "signup", F.replace(props, F.lit("}"), F.lit(', "k": 0}')))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("["), props, F.lit("]")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"s": "\\ud83d", "p": '), props, F.lit("}")))
        .when(F.col("value") > 20, F.replace(props, F.lit("}"), F.lit(', "n": ' + "9" * 70 + "}")))
        .otherwise(props)
    )
    return table(spark, sf, "events").select(
        "event_id", F.concat(shaped, F.lit("\n")).cast("binary").alias("raw")
    )


@query(
    "strict_json_events",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'malformed' WHEN 'signup' THEN 'malformed'
         WHEN 'purchase' THEN 'not_object' WHEN 'error' THEN 'lone_surrogate'
         ELSE CASE WHEN value > 20 THEN 'oversized_number' END END AS reject_reason,
       CASE WHEN event_type = 'view' AND NOT value > 20 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
       FROM events""",
)
def strict_json_events(spark: SparkSession, sf: str) -> DataFrame:
    return events.with_strict_event(_shaped_props(spark, sf)).select(
        "event_id", "reject_reason", F.try_variant_get("event", "$.k", "bigint").alias("k")
    )


@query(
    "closed_keys",
    """SELECT event_type, count(*) AS events, count(*) FILTER (WHERE list_sort(json_keys(body)) = ['k']) AS exact_k,
       count(*) FILTER (WHERE list_sort(json_keys(body)) = ['k', 'v']) AS exact_k_and_v
       FROM (SELECT event_type, CASE event_id % 4 WHEN 1 THEN regexp_replace(props, '}$', ', "v": 1}')
             WHEN 2 THEN '{"v": 2}' ELSE props END AS body FROM events) GROUP BY event_type""",
)
def closed_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Properties with a key added or replaced in some events."""
    kind = F.col("event_id") % 4
    body = (
        F.when(kind == 1, F.regexp_replace("props", r"\}$", ', "v": 1}'))
        .when(kind == 2, F.lit('{"v": 2}'))
        .otherwise(F.col("props"))
    )
    parsed = with_once(table(spark, sf, "events").select("event_type", body.alias("body")), v=F.try_parse_json("body"))
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.count_if(events.has_exact_keys(F.col("v"), ("k",))).alias("exact_k"),
        F.count_if(events.has_exact_keys(F.col("v"), ("k", "v"))).alias("exact_k_and_v"),
    )


def _written_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in one ISO form per event type; naive ones have no instant."""
    wall = F.col("ts").cast("timestamp_ntz").cast("string")
    compact = F.regexp_replace(wall, r"^(\d+)-(\d+)-(\d+) (\d+):(\d+):(\d+)(?:\..*)?$", "$1$2$3T$4$5$6Z")
    shaped = (
        F.when(F.col("event_type") == "view", iso_utc(F.col("ts")))
        .when(F.col("event_type") == "click", F.concat(wall, F.lit("+05:30")))
        .when(F.col("event_type") == "purchase", compact)
        .when(F.col("event_type") == "error", F.concat(wall, F.lit("-0800")))
        .otherwise(wall)
    )
    return table(spark, sf, "events").select("event_id", shaped.alias("captured_at"))


@query(
    "local_day",
    """WITH shifted AS (SELECT event_id, CASE event_type WHEN 'view' THEN ts WHEN 'purchase' THEN ts
         WHEN 'click' THEN ts - INTERVAL '5 hours 30 minutes' WHEN 'error' THEN ts + INTERVAL 8 HOUR
         END AS utc FROM events)
       SELECT event_id, CAST(utc AS DATE) AS utc_day,
         CAST(timezone('Asia/Seoul', timezone('UTC', utc)) AS DATE) AS seoul_day,
         CAST(timezone('America/New_York', timezone('UTC', utc)) AS DATE) AS new_york_day
       FROM shifted""",
)
def local_day(spark: SparkSession, sf: str) -> DataFrame:
    instants = with_once(_written_timestamps(spark, sf), utc=times.utc_instant(F.col("captured_at")))
    return instants.select(
        "event_id",
        F.col("utc").cast("date").alias("utc_day"),
        times.day_in_zone(F.col("utc"), ZONE).alias("seoul_day"),
        times.day_in_zone(F.col("utc"), "America/New_York").alias("new_york_day"),
    )


@query(
    "resolve_day",
    """SELECT event_id, CASE event_type WHEN 'view' THEN CAST(timezone('Asia/Seoul', timezone('UTC', ts)) AS DATE)
         WHEN 'click' THEN CAST(timezone('Asia/Seoul', timezone('UTC', ts)) AS DATE) - 1
         ELSE CAST(ts AS DATE) END AS day FROM events""",
)
def resolve_day(spark: SparkSession, sf: str) -> DataFrame:
    now = F.col("ts").cast("timestamp_ntz")
    literal = (
        F.when(F.col("event_type") == "view", F.lit("today"))
        .when(F.col("event_type") == "click", F.lit("previous-local-day"))
        .otherwise(now.cast("date").cast("string"))
    )
    return table(spark, sf, "events").select(
        "event_id", times.resolve_day(literal, now, ZONE).alias("day")
    )


@query(
    "digest_envelope",
    """WITH bodies AS (SELECT doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '","missing":null,"text":'
         || to_json(text)::VARCHAR || '}' AS body FROM documents)
       SELECT doc_id, sha256(body) AS digest, lang <> 'de' AS verified FROM bodies JOIN documents USING (doc_id)""",
)
def digest_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Digest of an envelope, checked against a declared digest that is wrong for one language."""
    fields = {
        "text": F.col("text"),
        "doc_id": F.col("doc_id"),
        "missing": F.lit(None).cast("string"),
        "lang": F.col("lang"),
    }
    sealed = with_once(table(spark, sf, "documents").select("doc_id", "lang", "text"), digest=ident.digest(fields))
    declared = F.when(F.col("lang") == "de", F.upper("digest")).otherwise(F.col("digest"))
    return sealed.select("doc_id", "digest", ident.digest_matches(fields, declared).alias("verified"))
