"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.once import bind
from ledgerloom.llm import (
    chat,
    jaccard,
    lm,
    merkle,
    mixing,
    neardup,
    packing,
    pii,
    quality,
    rules,
    sharding,
    spelling,
    toxicity,
)
from ledgerloom.llm.store import stored

SHARDS = 16


def byte_bpe(ending: str) -> str:
    """Where the public byte-level tokenizer lies, as a tokenizer file or as a file of ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"byte_bpe_50k.{ending}")


def added_tokens() -> dict[str, int]:
    """The added tokens of the public byte-level tokenizer."""
    with open(byte_bpe("json"), encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at 90 percent of three-word shingles, with their components and numbers of links."""
    joined = jaccard.join(_documents(spark, sf_dir), jaccard.Threshold(90), length=3, count_links=True)
    return joined.members.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


OP1_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
    FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS x(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))
),
reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, v FROM reach JOIN links ON r = u
),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id),
direct AS (SELECT u AS doc_id, count(*) AS n_links FROM links GROUP BY u),
same AS (
    SELECT doc_id, coalesce(min(doc_id) OVER (PARTITION BY g), doc_id) AS class_id
    FROM (SELECT doc_id, list_sort(list(g)) AS g FROM s GROUP BY doc_id)
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, coalesce(class_id, d.doc_id) AS class_id,
    coalesce(n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id) LEFT JOIN same USING (doc_id)
    LEFT JOIN direct USING (doc_id)
"""


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under a bigram model of the documents that are not held out."""
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return lm.score(_documents(spark, sf_dir), digest % 7 == 2)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into shards by the ``rows`` law."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = _documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = sharding.shard(sized, ["doc_id", "size", "text_crc32"], SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenized and packed into sequences of at most 2048 tokens."""
    pieces = packing.tokenize(_documents(spark, sf_dir), byte_bpe("tiktoken"), added=added_tokens())
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(stored(digested, "digested"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(_documents(spark, sf_dir).select("doc_id", "text"), keep=lambda rows: rows.drop("text"))

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listing("base_spans"), 256).alias("base_sha256"),
        pii.listing("spans").alias("spans"),
    )


def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings against those of their label at a cosine of 0.98."""
    return neardup.join(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


OP7_SQL = """
WITH RECURSIVE e AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS w
    FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reach(vec_id, r) AS (
    SELECT vec_id, vec_id FROM e UNION SELECT reach.vec_id, w FROM reach JOIN links ON r = u
),
n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r) AS component_id, min(r) = vec_id AS kept
FROM reach LEFT JOIN n ON u = vec_id GROUP BY vec_id
"""


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").where(~held_out)
    scored = quality.score(_documents(spark, sf_dir), labels)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    # Fixed values of the added conversation.
    hostile = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.read_back(chat.format_conversations(rows.unionByName(hostile), byte_bpe("json")))


OP9_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
e AS (
    SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
        + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]')) AS n FROM c
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
        AS loss_sha256,
    sum(3 + 6 + length(role) + 7 + n + 4)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules for every document."""
    judged = rules.judge(_documents(spark, sf_dir).select("doc_id", "text", "lang"), lang="lang")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: Stop words of the verdict in the check's own list.
_STOP_SQL = ", ".join(
    "'" + word + "'"
    for word in (
        "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch "
        "the of and to in a is that for it as was with be by on not he his are this at from "
        "de la que el en y a los se del las un por con no una su para es al lo como "
        "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se"
    ).split()
)

OP10_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        coalesce(lower(regexp_extract(lang, '^([A-Za-z]+)([^A-Za-z]|$)', 1)) IN ('de', 'en', 'es', 'fr'), false) AS listed,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d),
five AS (
    SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o
        || ' ' || lead(w, 4) OVER o AS f
    FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
),
twice AS (
    SELECT r, i FROM five WHERE f IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, f) > 1
),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS x(k) GROUP BY r),
lines AS (
    SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
),
m AS (
    SELECT d.r, doc_id, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        listed, len(list_filter(w, lambda x: lower(x) IN ({_STOP_SQL}))) AS stops
    FROM d JOIN lines USING (r) LEFT JOIN covered USING (r)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 1.5 AND 15 AND n_symbols::DOUBLE / n_words <= 0.1
        AND (NOT listed OR (stops + 1)::DOUBLE / n_words >= 0.02) AND n_dup_lines::DOUBLE / greatest(n_lines, 1) <= 0.4 AS kept
FROM b
"""

#: Checksums in SQL: a table from the polynomial, and a fold over the bytes of a text.
_CRC_TABLE = """
crc AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1
        THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS x(i)
)
"""


def _crc_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, with ``crc`` in scope."""
    code = f"hex(encode({text}))"
    at = f"list_transform(range(length({code}) // 2), lambda k: ('0x' || substr({code}, 2 * k + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {at}), {step}))"


_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and what root a tampered text gives with it."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def leaf(text: Column) -> Column:
        return merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    rows = _documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        F.unhex(leaf(F.col("text"))).alias("leaf"),
        F.unhex(leaf(F.when(tampered, lower).otherwise(F.col("text")))).alias("found"),
    )
    made = merkle.manifest(rows, F.lower(F.hex("leaf")), F.col("lang"), [F.col("doc_id")])
    folded = merkle.folded(F.lower(F.hex("row.found")), F.col("proof"))
    return made.leaves.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        bind(folded, lambda root: F.struct(root.alias("folded_root"), (root == F.col("root")).alias("verified"))).alias("f"),
        F.col("tree").alias("lang"),
        F.col("index").alias("leaf_index"),
    ).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "f.*", "lang", "leaf_index")


def _leaf_sql(text: str) -> str:
    def field(value: str) -> str:
        return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"

    return f"sha256({' || '.join(field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
    SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, {_leaf_sql("text")} AS leaf,
        {_leaf_sql(_LOWER_SQL.format("text"))} AS lowered
    FROM documents
),
l AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY tree) AS size,
        CASE WHEN coalesce({_crc_sql("doc_id::VARCHAR")} % 3 = 0, false) THEN lowered ELSE leaf END AS found
    FROM d, crc
),
nodes(k, tree, i, size, h) AS (
    SELECT 0, tree, i, size, leaf FROM l
    UNION ALL
    SELECT any_value(k) + 1, tree, i // 8, (any_value(size) + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
    FROM nodes WHERE size > 1 GROUP BY tree, i // 8
),
tops AS (
    SELECT tree, h, k AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS size
    FROM nodes WHERE size = 1
),
heads(k, i, size, h) AS (
    SELECT 0, i, size, h FROM tops
    UNION ALL
    SELECT any_value(k) + 1, i // 8, (any_value(size) + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
    FROM heads WHERE size > 1 GROUP BY i // 8
),
steps AS (
    SELECT a.tree, a.k, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
    FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.k = b.k AND a.i // 8 = b.i // 8
    WHERE a.size > 1 GROUP BY a.tree, a.k, a.i
    UNION ALL
    SELECT NULL, a.k, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), ''),
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '')
    FROM heads a JOIN heads b ON a.k = b.k AND a.i // 8 = b.i // 8
    WHERE a.size > 1 GROUP BY a.k, a.i
),
path AS (
    SELECT l.tree, l.i AS leaf_index, s.k, s.l, s.r
    FROM l JOIN steps s ON s.tree = l.tree AND s.i = l.i // (8 ** s.k)::BIGINT
    UNION ALL
    SELECT l.tree, l.i, height + s.k, s.l, s.r
    FROM l JOIN tops t ON t.tree = l.tree JOIN steps s ON s.tree IS NULL AND s.i = t.i // (8 ** s.k)::BIGINT
),
folds(tree, leaf_index, k, h) AS (
    SELECT tree, i, 0, found FROM l
    UNION ALL
    SELECT f.tree, f.leaf_index, f.k + 1, sha256(p.l || f.h || p.r)
    FROM folds f JOIN path p ON p.tree = f.tree AND p.leaf_index = f.leaf_index AND p.k = f.k
),
ends AS (SELECT tree, leaf_index, arg_max(h, k) AS h FROM folds GROUP BY tree, leaf_index),
proofs AS (SELECT tree, leaf_index, sha256(string_agg(l || r, '' ORDER BY k)) AS h FROM path GROUP BY tree, leaf_index)
SELECT doc_id, leaf, t.h AS subroot, root.h AS root, coalesce(p.h, sha256('')) AS proof_sha256,
    e.h AS folded_root, e.h = root.h AS verified, lang, l.i::BIGINT AS leaf_index
FROM l JOIN tops t USING (tree) JOIN (SELECT h FROM heads WHERE size = 1) root ON true
    JOIN ends e ON e.tree = l.tree AND e.leaf_index = l.i LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_index = l.i
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words they are variants of."""
    words = spelling.counted_words(_documents(spark, sf_dir).select("doc_id", "text"))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


OP12_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS run
    FROM documents
),
own AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
checked AS (
    SELECT run, n, {_crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM own, crc
),
spelt AS (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM checked
),
v AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM v, unnest(range(length(word))) AS x(i)
),
near AS (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = cut.rest
    UNION
    SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = cut.rest
),
best AS (
    SELECT word, count(*) AS n_near, max(n) AS form_n, min(other) FILTER (n = most) AS form
    FROM (SELECT *, max(n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word
),
formed AS (
    SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN best.form_n >= 10 * v.n THEN form END AS form, CASE WHEN best.form_n >= 10 * v.n THEN best.form_n END AS form_n
    FROM v LEFT JOIN best USING (word)
),
walk(word, here, k) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL
    SELECT walk.word, form, k + 1 FROM walk JOIN formed ON formed.word = walk.here WHERE form IS NOT NULL
)
SELECT formed.word, form, root, n, n_near, form_n::BIGINT AS form_n
FROM formed JOIN (SELECT word, arg_max(here, k) AS root FROM walk GROUP BY word) USING (word)
"""


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").where(~held_out)
    scored = toxicity.score(_documents(spark, sf_dir), labels)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "lang",
        "threshold",
        F.col("toxic").alias("over_threshold"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sharding": op3_sharding,
    "op4_source_mixing": op4_source_mixing,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_pii": op6_pii,
    "op7_embedding_neardup": op7_embedding_neardup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_toxicity": op13_toxicity,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op7_embedding_neardup": OP7_SQL,
    "op9_chat_formatting": OP9_SQL,
    "op10_quality_rules": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
}
