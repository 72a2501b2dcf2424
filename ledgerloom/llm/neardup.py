"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosine checks.

Vectors are scaled to length one; a table's bucket is the whole parts of k random Gaussian
projections, shifted and divided by a width, so near vectors often share a bucket. Vectors
meet in several tables; every meeting pair is compared by cosine in double precision, and
a pair that meets in several tables counts in the first of them.

The number of projections follows the size of the largest label, which keeps buckets of
unrelated vectors small at any size, and the number of tables follows from the wanted
recall at the threshold, where it is least.

Equal vectors of a label are one class with a count. Buckets that hold more than a tile
are split, and each pair of tiles is compared by one task, so no bucket is gathered
whole. Tasks emit counts and spanning links, never pairs.

Defined results: a vector whose label or embedding is null, that is all zero, or that has
a null or non-finite component links with nothing and is its own component; vectors of
different lengths do not link; a null id gets no component; repeated ids count as vectors of
their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.store import by_group, stored

WIDTH = 1.0
SEED = 20_240_501
#: Unrelated vectors of a label that a bucket holds on average.
BUCKET_ROWS = 20
TILE = 2_000
BLOCK = 500


@dataclass(frozen=True)
class Plan:
    projections: int
    tables: int

    @staticmethod
    def of(largest_label: int, cosine: float, miss: float) -> Plan:
        """Enough projections for the largest label, enough tables for the recall."""
        near = _meet(math.sqrt(max(2 - 2 * cosine, 1e-12)))
        far = _meet(math.sqrt(2))
        projections = max(2, math.ceil(math.log(max(largest_label / BUCKET_ROWS, 1)) / -math.log(far)))
        chance = near**projections
        return Plan(projections, math.ceil(math.log(miss) / math.log(1 - chance)))


def _meet(distance: float) -> float:
    """Chance that one projection puts two vectors at this distance into one bucket."""
    r = WIDTH / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; each is first divided by its largest part, so no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def _buckets(unit: np.ndarray, plan: Plan) -> np.ndarray:
    """Bucket number of every row in every table."""
    rng = np.random.default_rng([SEED, unit.shape[1]])
    lines = rng.standard_normal((unit.shape[1], plan.tables * plan.projections))
    shifts = rng.random(plan.tables * plan.projections) * WIDTH
    cells = np.floor((unit @ lines + shifts) / WIDTH).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(unit), plan.tables, plan.projections)
    factors = rng.integers(1, 1 << 63, plan.projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = (cells * factors).sum(axis=2, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _hashed(plan: Plan):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                some = column.take(pa.array(rows))
                buckets = _buckets(_unit(_matrix(some)), plan)
                kept = [batch.column(c).take(pa.array(rows)) for c in ("cls", "copies", "label", "length")]
                flat = pa.array(buckets.reshape(-1))
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * plan.tables)
                yield pa.RecordBatch.from_arrays(
                    [*kept, some, pa.ListArray.from_arrays(offsets, flat)],
                    names=["cls", "copies", "label", "length", "vector", "buckets"],
                )

    return apply


def _compare(cosine: float):
    """Links of one bucket, or between two tiles of it."""

    def work(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        table = group.column("table")[0].as_py()
        classes = group.column("cls").to_numpy()
        copies = group.column("copies").to_numpy()
        side = group.column("side").to_numpy()
        unit = _unit(_matrix(group.column("vector")))
        buckets = group.column("buckets").combine_chunks()
        before = buckets.flatten().to_numpy().reshape(len(buckets), -1)[:, :table]
        # A tile against itself has side 0 only; two tiles have sides 1 and 2.
        one = np.flatnonzero(side < 2)
        two = one if side.max() == 0 else np.flatnonzero(side == 2)
        links = np.zeros(len(classes), np.int64)
        parent = np.arange(len(classes))
        spanning = []

        def root(node: int) -> int:
            while parent[node] != node:
                parent[node] = parent[parent[node]]
                node = parent[node]
            return node

        for i in range(0, len(one), BLOCK):
            rows = one[i : i + BLOCK]
            for j in range(i if two is one else 0, len(two), BLOCK):
                others = two[j : j + BLOCK]
                near = unit[rows] @ unit[others].T >= cosine
                if two is one and i == j:
                    near = np.triu(near, 1)
                left, right = np.nonzero(near)
                left, right = rows[left], others[right]
                fresh = ~(before[left] == before[right]).any(axis=1)
                left, right = left[fresh], right[fresh]
                np.add.at(links, left, copies[right])
                np.add.at(links, right, copies[left])
                for a, b in zip(left.tolist(), right.tolist(), strict=True):
                    p, q = root(a), root(b)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        spanning.append((a, b))
        counted = np.flatnonzero(links)
        if len(counted) == 0:
            return None
        u = np.concatenate([classes[counted], classes[[a for a, _ in spanning]]])
        v = np.concatenate([classes[counted], classes[[b for _, b in spanning]]])
        n = np.concatenate([links[counted], np.zeros(len(spanning), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(n)], names=["u", "v", "links"])

    return work


def join(
    df: DataFrame,
    cosine: float = 0.98,
    miss: float = 1e-4,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector; ``miss`` is the chance to miss a link at the threshold."""
    rows = df.select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.col(vector_column).cast("array<double>").alias("_v"),
        F.col(label_column).cast("string").alias("_label"),
    )
    finite = F.forall(
        "_v", lambda x: x.isNotNull() & ~F.isnan(x) & (x != float("inf")) & (x != float("-inf"))
    )
    usable = F.coalesce(
        F.col("_label").isNotNull() & F.col("_v").isNotNull() & finite & F.exists("_v", lambda x: x != 0),
        F.lit(False),
    )
    keyed = stored(
        rows.withColumn("_usable", usable & F.col("_id").isNotNull()).withColumn(
            "_key", F.when(F.col("_usable"), F.sha2(F.concat_ws("|", F.array("_label"), F.col("_v").cast("array<string>")), 256))
        ),
        "vectors",
    )
    used = keyed.where("_usable")
    classes = stored(
        used.groupBy("_key").agg(
            F.min("_id").alias("cls_id"),
            F.count("*").alias("copies"),
            F.first("_label").alias("label"),
            F.first("_v").alias("vector"),
        ).withColumn("cls", F.xxhash64("_key")).withColumn("length", F.size("vector")),
        "classes",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    plan = Plan.of(largest, cosine, miss)
    hashed = classes.select("cls", "copies", "label", "length", "vector").mapInArrow(
        _hashed(plan),
        "cls long, copies long, label string, length int, vector array<double>, buckets array<bigint>",
    )
    met = stored(hashed, "hashed").select("*", F.posexplode("buckets").alias("table", "bucket"))
    keys = ["label", "length", "table", "bucket"]
    sizes = (
        met.groupBy(*keys).count().where("count > 1").withColumn("tiles", F.ceil(F.col("count") / TILE).cast("int"))
    )
    full = met.join(sizes.drop("count"), keys).withColumn(
        "tile", F.pmod(F.col("cls"), F.col("tiles")).cast("int")
    )

    def side(other):
        return F.when(other == F.col("tile"), 0).when(F.col("tile") < other, 1).otherwise(2)

    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(
            F.least(other, F.col("tile")).alias("low"),
            F.greatest(other, F.col("tile")).alias("high"),
            side(other).cast("int").alias("side"),
        ),
    )
    tasks = full.select(*keys, "cls", "copies", "vector", "buckets", F.explode(pairs).alias("p")).select(
        *keys, "p.low", "p.high", "p.side", "cls", "copies", "vector", "buckets"
    )
    found = stored(
        by_group(tasks, [*keys, "low", "high"], _compare(cosine), "u long, v long, links long"), "found"
    )
    counts = found.where("links > 0").groupBy(F.col("u").alias("cls")).agg(F.sum("links").alias("links"))
    linked = components(found.select("u", "v"))
    named = linked.join(classes, linked["node"] == classes["cls"]).select("component", "cls", "cls_id")
    least = named.groupBy("component").agg(F.min("cls_id").alias("component_id"))
    by_class = (
        classes.select("_key", "cls", "cls_id", "copies")
        .join(counts, "cls", "left")
        .join(named.join(least, "component").select("cls", "component_id"), "cls", "left")
        .select("_key", "cls_id", "copies", "links", "component_id")
    )
    joined = keyed.select("_id", "_key").join(by_class, "_key", "left")
    component = F.coalesce("component_id", "cls_id", "_id")
    return joined.select(
        F.col("_id").alias(id_column),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("_id")).alias("kept"),
    )
