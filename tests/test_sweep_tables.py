"""Tables of sweeps hold what their queries read."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

from ledgerloom.plans import document_queries, sample_tables

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_checks_of_targets_store_no_texts(spark, tmp_path):
    rng = random.Random(3)
    sf = str(tmp_path)
    texts = [f"{rng.getrandbits(80_000):x}" for _ in range(100)]
    rows = [(n, "web", "fr" if n % 3 else "en", len(text), text) for n, text in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    marks = [(n, int(n % 5 > 0), int(n % 7 == 0)) for n in range(100)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    found = document_queries.disposition_check(spark, sf).groupBy("outcome").count().collect()
    unexpected = sum(t and q for _, q, t in marks)
    debts = [n for n, q, t in marks if q and not t and len(texts[n]) > 5_000]
    assert {r["outcome"]: r["count"] for r in found} == {"unexpected_targets": unexpected, "ok": 100 - unexpected}
    assert len(debts) > 60
    places = [path for (_, _, own), path in sample_tables._written.items() if own == sf]
    stored = sum(file.stat().st_size for place in places for file in Path(place).rglob("*.parquet"))
    assert 0 < stored < sum(map(len, texts)) / 10
    heads = document_queries.sweep_changes(spark, sf)
    whole = document_queries.sweep_decisions(spark, sf)[1]
    assert "body" not in heads.columns and whole.drop("body").exceptAll(heads).count() == 0
    assert whole.where(F.sha2("body", 256) != F.col("expected_sha256")).count() == 0
