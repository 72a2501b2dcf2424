"""Similarity join of texts on the Jaccard similarity of their word n-gram sets.

The method: every n-gram is hashed into a group, the counts of a text's groups are a
point, the overlap of two texts is at most the sum of the smaller coordinates, and
pairs that this bound lets through are compared exactly. Points are indexed in a tree
whose boxes hold the largest coordinates (``CountTree``).

Boxes alone do not prune points of many coordinates, so the upper levels of the index
are cells: with similarity at least t, two texts differ in at most D n-grams, D being
(1 - t) / t times the smaller set. Of K = D + 1 blocks of groups at least one then has
no difference, and its equal counts, on very fine groups, put both texts into one cell.
Cells only say which texts can be similar at all; the connected parts of that relation
are indexed by one tree each, or by several tiles when they are large.

Equal sets are one class from the start, so copies cost nothing. Each cell contributes
edges to its smallest member only, first within a task and then over tasks, so no cell
emits its pairs and none is gathered. Where classes are all that is asked for, trees skip
pairs that earlier links connect, so links are a spanning set: enough for classes and far
fewer than pairs. With ``count_links`` every linked pair is compared and counted, one tile or
pair of tiles in a task, and a task still emits one number a set and a spanning set of
links, never the pairs. Counting takes time in proportion to the pairs in large groups of near
copies that all differ.

Sets are told apart by 64-bit hashes. A link can be missed only if all difference-free
blocks of a pair hold too few n-grams; up to six partitions are tried for small texts,
which by estimate leaves a chance of at most about 1e-8 for a pair right at a threshold of
0.8, and far less at 0.9.

Defined results: null and empty texts, and texts without words, have no n-grams and link
with nothing; a text shorter than the n-gram length is one n-gram; rows without an id
link with nothing and get no component; repeated ids and rows each get a result row, and
the links of a row are the other rows with an id that it links with; an
empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words
from ledgerloom.llm.components import components
from ledgerloom.llm.store import by_group, stored

#: Size classes grow by half; a pair is looked for in the class of its smaller set.
CLASS_GROWTH = 1.5
#: Blocks from which on a block must hold two n-grams to make a cell.
MANY_BLOCKS = 32
PARTITIONS = 6
#: N-grams that one tile of a large part holds, about 8 bytes each.
TILE_NGRAMS = 1_000_000
LEAF = 16
#: Cell rows that a task keeps before it emits them.
FLUSH_ROWS = 2_000_000
#: Candidate rows up to which their ids are sent to every task; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000
#: A class of at least this part of all rows is frequent; there are at most so many.
FREQUENT_PART = 1_000
LARGEST_ID = (1 << 63) - 1
NOT_SPACE = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Threshold:
    """Similarity numerator / denominator, in whole numbers."""

    numerator: int
    denominator: int = 100

    def links(self, overlap: np.ndarray | int, left: int, right: np.ndarray | int) -> np.ndarray | bool:
        return self.denominator * overlap >= self.numerator * (left + right - overlap)

    def overlap_needed(self, left: int, right: np.ndarray | int) -> np.ndarray | int:
        """Smallest overlap that links sets of these sizes."""
        total = self.numerator + self.denominator
        return -(-self.numerator * (left + right) // total)

    def least_partner(self, size: np.ndarray) -> np.ndarray:
        return -(-size * self.numerator // self.denominator)

    def most_differences(self, smaller: np.ndarray) -> np.ndarray:
        return smaller * (self.denominator - self.numerator) // self.numerator


def _class_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * CLASS_GROWTH)))
    return np.array(starts, dtype=np.int64)


_STARTS = _class_starts()


def set_key(grams: np.ndarray) -> int:
    """64-bit key of a set, as a signed number; 0 is the empty set."""
    if len(grams) == 0:
        return 0
    total = np.add.reduce(words.mix(grams)) + np.uint64(len(grams))
    return int(words.mix(np.array([total], np.uint64)).view(np.int64)[0])


def _cells(grams: np.ndarray, sizes: np.ndarray, classes: np.ndarray, blocks: np.ndarray) -> tuple:
    """Cell hashes of sets that lie one after another, and the set of each cell."""
    chosen = np.arange(len(sizes))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out_cells, out_sets = [], []
    for partition in range(PARTITIONS):
        if len(chosen) == 0:
            break
        amounts, counts = sizes[chosen], blocks[chosen]
        within = np.arange(amounts.sum()) - np.repeat(np.cumsum(amounts) - amounts, amounts)
        mine = words.mix(grams[np.repeat(starts[chosen], amounts) + within] ^ np.uint64(0x51ED27 + partition))
        base = np.cumsum(counts) - counts
        block = (((mine >> np.uint64(32)) * np.repeat(counts, amounts).astype(np.uint64)) >> np.uint64(32)).astype(
            np.int64
        ) + np.repeat(base, amounts)
        total = int(counts.sum())
        held = np.bincount(block, minlength=total)
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, block, words.mix(mine))
        owner = np.repeat(np.arange(len(chosen)), counts)
        number = np.arange(total) - base[owner]
        label = words.mix(
            (classes[chosen][owner].astype(np.uint64) << np.uint64(48))
            ^ (number.astype(np.uint64) << np.uint64(8))
            ^ np.uint64(partition)
        )
        usable = held >= np.where(counts[owner] >= MANY_BLOCKS, 2, 1)
        out_cells.append(words.mix(sums + label)[usable])
        out_sets.append(chosen[owner[usable]])
        empty = np.zeros(len(chosen), bool)
        empty[owner[held == 0]] = True
        chosen = chosen[empty & (counts < MANY_BLOCKS)]
    return out_cells, out_sets


def cells_of(sets: list[np.ndarray], threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Cell hashes of all sets and the number of the set that each belongs to."""
    all_sizes = np.array([len(s) for s in sets], dtype=np.int64)
    own = np.searchsorted(_STARTS, all_sizes, "right") - 1
    lowest = np.searchsorted(_STARTS, np.maximum(threshold.least_partner(all_sizes), 1), "right") - 1
    cells, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for step in range(int((own - lowest).max(initial=0)) + 1):
        level = own - step
        blocks = threshold.most_differences(_STARTS[np.maximum(level, 0) + 1] - 1) + 1
        # With one block no difference is allowed, and equal sets are one class already.
        part = np.flatnonzero((level >= lowest) & (all_sizes > 0) & (blocks > 1))
        if len(part):
            grams = np.concatenate([sets[i] for i in part])
            found, sets_of = _cells(grams, all_sizes[part], level[part], blocks[part])
            cells += found
            owners += [part[s] for s in sets_of]
    return np.concatenate(cells), np.concatenate(owners)


class CountTree:
    """Bulk-loaded tree over count vectors; searches by the sum of coordinate minima."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.vectors, self.sizes = vectors, sizes
        order = np.lexsort((vectors.argmax(axis=1) if len(vectors) else sizes, sizes))
        self.levels = []
        members = [order[i : i + LEAF] for i in range(0, len(order), LEAF)]
        boxes = np.array([vectors[m].max(axis=0) for m in members])
        low = np.array([sizes[m].min() for m in members])
        high = np.array([sizes[m].max() for m in members])
        self.levels.append((members, boxes, low, high))
        while len(members) > LEAF:
            members = [np.arange(i, min(i + LEAF, len(boxes))) for i in range(0, len(boxes), LEAF)]
            boxes = np.array([boxes[m].max(axis=0) for m in members])
            low = np.array([low[m].min() for m in members])
            high = np.array([high[m].max() for m in members])
            self.levels.append((members, boxes, low, high))

    def search(self, vector: np.ndarray, size: int, threshold: Threshold) -> np.ndarray:
        """Points whose bound reaches the overlap that a link with this one needs."""
        least, most = threshold.least_partner(size), size * threshold.denominator // threshold.numerator
        nodes = np.arange(len(self.levels[-1][0]))
        for members, boxes, low, high in reversed(self.levels):
            bound = np.minimum(boxes[nodes], vector).sum(axis=1)
            needed = threshold.overlap_needed(size, np.maximum(low[nodes], least))
            nodes = nodes[(bound >= needed) & (low[nodes] <= most) & (high[nodes] >= least)]
            if len(nodes) == 0:
                return nodes
            nodes = np.concatenate([members[n] for n in nodes])
        near = (self.sizes[nodes] >= least) & (self.sizes[nodes] <= most)
        bound = np.minimum(self.vectors[nodes], vector).sum(axis=1)
        return nodes[near & (bound >= threshold.overlap_needed(size, self.sizes[nodes]))]


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Common values of two sorted sets."""
    small, large = (left, right) if len(left) <= len(right) else (right, left)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int(np.count_nonzero(large[at] == small))


def _root(parent: list[int], node: int) -> int:
    while parent[node] != node:
        parent[node] = parent[parent[node]]
        node = parent[node]
    return node


def _points(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Group counts of each set, on about as many groups as a set has n-grams, and the sizes."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    groups = 1 << int(np.clip(np.ceil(np.log2(max(1, np.median(sizes)))), 4, 12))
    mask = np.uint64(groups - 1)
    vectors = np.array([np.bincount((s & mask).astype(np.int64), minlength=groups) for s in sets], dtype=np.int32)
    return vectors, sizes


def spanning_links(
    sets: list[np.ndarray], asks: np.ndarray, threshold: Threshold
) -> list[tuple[int, int]]:
    """Links that connect what all links between asking sets and any sets connect.

    The first set is compared with all others before, so that a group of near copies
    is connected by as many comparisons as it has members.
    """
    vectors, sizes = _points(sets)
    parent = list(range(len(sets)))
    links = []

    def compare(i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            a, b = _root(parent, i), _root(parent, j)
            if a != b and threshold.links(overlap(sets[i], sets[j]), int(sizes[i]), int(sizes[j])):
                parent[max(a, b)] = min(a, b)
                links.append((i, j))

    bound = np.minimum(vectors, vectors[0]).sum(axis=1)
    compare(0, np.flatnonzero(bound >= threshold.overlap_needed(int(sizes[0]), sizes)))
    queue = [i for i in range(1, len(sets)) if asks[i]]
    tree = CountTree(vectors, sizes) if queue else None
    closed = np.zeros(len(sets), bool)
    for i in queue:
        if len(links) == len(sets) - 1:
            break
        found = tree.search(vectors[i], int(sizes[i]), threshold)
        compare(i, found[~closed[found]])
        closed[i] = True
    return links


def counted_links(
    sets: list[np.ndarray], asks: np.ndarray, copies: np.ndarray, threshold: Threshold, across: bool
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Copies of the sets that each set links with, and links that connect what all links connect.

    ``across`` counts pairs of an asking set and one that does not ask; else all sets ask
    and every pair counts once.
    """
    vectors, sizes = _points(sets)
    tree = CountTree(vectors, sizes)
    values, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    grams = np.split(numbers, np.cumsum(sizes)[:-1])
    held = np.zeros(len(values), np.int64)
    counts = np.zeros(len(sets), np.int64)
    parent = list(range(len(sets)))
    spanning = []
    waiting = ~asks if across else np.ones(len(sets), bool)
    for i in np.flatnonzero(asks).tolist():
        waiting[i] = False
        found = tree.search(vectors[i], int(sizes[i]), threshold)
        found = found[waiting[found]]
        if len(found) == 0:
            continue
        held[grams[i]] = 1
        starts = np.cumsum(sizes[found]) - sizes[found]
        common = np.add.reduceat(held[np.concatenate([grams[j] for j in found])], starts)
        held[grams[i]] = 0
        linked = found[threshold.links(common, int(sizes[i]), sizes[found])]
        counts[i] += copies[linked].sum()
        counts[linked] += copies[i]
        if len(spanning) == len(sets) - 1:
            continue
        for j in linked.tolist():
            a, b = _root(parent, i), _root(parent, j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                spanning.append((i, j))
    return counts, spanning


def _digests(length: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            for start, stop in words.slices(texts):
                sets = words.distinct_runs(texts.slice(start, stop - start), length)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(start, stop - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) for s in sets], pa.int64()),
                    ],
                    names=["id", "n_shingles", "key"],
                )

    return apply


def _emitted(cells: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (cell, key, hub) sorted by cell; hub is the smallest key of the cell here."""
    order = np.lexsort((keys, cells))
    cells, keys = cells[order], keys[order]
    first = np.ones(len(cells), bool)
    first[1:] = cells[1:] != cells[:-1]
    hubs = keys[np.maximum.accumulate(np.where(first, np.arange(len(cells)), 0))]
    return first, np.stack([cells, keys]), hubs


def _cell_rows(length: int, threshold: Threshold):
    def rows(cells: list, keys: list) -> pa.RecordBatch:
        first, (cell, key), hubs = _emitted(np.concatenate(cells).view(np.int64), np.concatenate(keys))
        edge = np.unique(np.stack([key, hubs])[:, ~first & (key != hubs)], axis=1)
        both = np.concatenate([cell[first], edge[0]])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(both),
                pa.array(np.concatenate([key[first], edge[0]])),
                pa.array(np.concatenate([key[first], edge[1]])),
            ],
            names=["cell", "key", "hub"],
        )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, keys, held = [], [], 0
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column("_text")
            for start, stop in words.slices(texts):
                sets = []
                own = []
                for grams in words.distinct_runs(texts.slice(start, stop - start), length):
                    key = set_key(grams)
                    if len(grams) and key not in seen:
                        seen.add(key)
                        sets.append(grams)
                        own.append(key)
                if not sets:
                    continue
                found, owners = cells_of(sets, threshold)
                cells.append(found)
                keys.append(np.array(own, np.int64)[owners])
                held += len(found)
                if held >= FLUSH_ROWS:
                    yield rows(cells, keys)
                    cells, keys, held, seen = [], [], 0, set()
        if held:
            yield rows(cells, keys)

    return apply


def _hub_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from rows sorted by (cell, key): to the first key of the cell."""
    last_cell = last_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cell, key, hub = (batch.column(c).to_numpy() for c in ("cell", "key", "hub"))
        ready = key != hub
        edges = [np.stack([key[ready], hub[ready]])]
        cell, key = cell[~ready], key[~ready]
        if len(cell):
            first = np.ones(len(cell), bool)
            first[1:] = cell[1:] != cell[:-1]
            hubs = key[np.maximum.accumulate(np.where(first, np.arange(len(cell)), 0))]
            if last_cell == cell[0]:
                run = len(cell) if first.sum() == 1 else int(np.flatnonzero(first)[1])
                hubs[:run] = last_key
            last_cell, last_key = cell[-1], hubs[-1]
            other = key != hubs
            edges.append(np.stack([key[other], hubs[other]]))
        out = np.unique(np.concatenate(edges, axis=1), axis=1)
        if out.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], names=["u", "v"])


def _group_links(length: int, threshold: Threshold, counting: str = ""):
    """Links of one group; ``counting`` is empty, or "inner" or "across" for rows (u, u, number of links) too."""

    def work(group: pa.Table) -> pa.RecordBatch | None:
        group = group.combine_chunks()
        texts = pa.chunked_array(group.column("_text").chunks, pa.string()).combine_chunks()
        sets, keys, asks, copies = [], [], [], []
        seen = {}
        wanted = group.column("key").to_pylist()
        asking = group.column("asks").to_pylist()
        repeats = group.column("copies").to_pylist()
        # The smallest key first: the hub that most members share.
        order = sorted(range(len(wanted)), key=lambda row: wanted[row])
        all_sets = words.distinct_runs(texts, length)
        for row in order:
            key = wanted[row]
            if set_key(all_sets[row]) != key:
                continue
            if key in seen:
                asks[seen[key]] = asks[seen[key]] or asking[row]
                continue
            seen[key] = len(sets)
            sets.append(all_sets[row])
            keys.append(key)
            asks.append(asking[row])
            copies.append(repeats[row])
        if len(sets) < 2:
            return None
        if counting:
            counts, links = counted_links(
                sets, np.array(asks, bool), np.array(copies, np.int64), threshold, counting == "across"
            )
        else:
            counts, links = np.zeros(len(sets), np.int64), spanning_links(sets, np.array(asks, bool), threshold)
        linked = np.flatnonzero(counts)
        names = np.array(keys, np.int64)
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([names[ends[:, 0]], names[linked]])),
                pa.array(np.concatenate([names[ends[:, 1]], names[linked]])),
                pa.array(np.concatenate([np.zeros(len(ends), np.int64), counts[linked]])),
            ],
            names=["u", "v", "n"],
        )

    return work


@dataclass(frozen=True)
class Joined:
    """members: (id, n_shingles, class_id, component_id, n_links, key, kept_key); links: spanning pairs of classes' ids.

    ``n_links`` is there if links were counted, ``key`` and ``kept_key`` if keys were asked for.
    """

    members: DataFrame
    links: DataFrame


def join(
    df: DataFrame,
    threshold: Threshold,
    length: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    count_links: bool = False,
    with_keys: bool = False,
) -> Joined:
    """Classes of texts connected by similarities of at least ``threshold``; ``count_links`` adds each row's links.

    ``with_keys`` adds the key of each row's set and ``kept_key``, the least key of its
    component's sets that have the component's id.
    """
    source = df.select(F.col(id_column).cast("bigint").alias("_id"), F.col(text_column).alias("_text"))
    digests = stored(source.mapInArrow(_digests(length), "id long, n_shingles long, key long"), "digests")
    classes = digests.where("n_shingles > 0 AND id IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("class_id"), F.first("n_shingles").alias("n"), F.count("*").alias("copies")
    )
    cells = source.where("_id IS NOT NULL").mapInArrow(
        _cell_rows(length, threshold), "cell long, key long, hub long"
    )
    edges = (
        cells.repartition("cell")
        .sortWithinPartitions("cell", "key")
        .mapInArrow(_hub_edges, "u long, v long")
    )
    parts = components(edges)
    members = stored(
        parts.join(classes, parts["node"] == classes["key"]).select("key", "class_id", "n", "copies", "component"),
        "parts",
    )
    links = stored(_links(source, members, threshold, length, count_links), "links")
    linked = components(links)
    named = linked.join(classes, linked["node"] == classes["key"])
    firsts = [F.min("class_id").alias("component_id")]
    if with_keys:
        firsts.append(F.min_by("key", F.struct("class_id", "key")).alias("kept_key"))
    least = named.groupBy("component").agg(*firsts)
    found = named.join(least, "component").select("key", *least.columns[1:])
    by_key = classes.select("key", "class_id", "copies").join(found, "key", "left")
    counted = []
    if count_links:
        sums = links.where("n > 0").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("n"))
        by_key = by_key.join(sums, "key", "left")
        direct = F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
        counted = [F.when(F.col("id").isNotNull(), direct).otherwise(0).cast("bigint").alias("n_links")]
    keys = ["key", F.coalesce("kept_key", "key").alias("kept_key")] if with_keys else []
    rows = _with_classes(digests, stored(by_key, "by_key")).select(
        "id",
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "class_id", "id")).alias("component_id"),
        *counted,
        *keys,
    )
    ids = classes.select("key", "class_id")
    named_links = (
        links.where("u <> v").join(ids.select(F.col("key").alias("u"), F.col("class_id").alias("left_id")), "u")
        .join(ids.select(F.col("key").alias("v"), F.col("class_id").alias("right_id")), "v")
        .select("left_id", "right_id")
    )
    return Joined(rows.withColumnRenamed("id", id_column), named_links)


def _with_classes(digests: DataFrame, by_key: DataFrame) -> DataFrame:
    """Rows with what is known of their class. Frequent classes, of bounded number, are sent to the rows.

    Empty sets are of no class and meet nothing.
    """
    least = max(1, digests.count() // FREQUENT_PART)
    frequent = F.broadcast(by_key.where(F.col("copies") > least))
    some, none = digests.where("n_shingles > 0"), digests.where("n_shingles = 0")
    hot = some.join(frequent, "key")
    rest = some.join(frequent.select("key"), "key", "left_anti").join(by_key, "key", "left")
    return hot.unionByName(rest).unionByName(none, allowMissingColumns=True)


def _links(source: DataFrame, members: DataFrame, threshold: Threshold, length: int, count_links: bool) -> DataFrame:
    """Spanning links inside the parts, with the texts of their members read once more, and counts of all links."""
    sizes = members.groupBy("component").agg(
        F.ceil(F.sum("n") / TILE_NGRAMS).cast("int").alias("tiles")
    )
    tiled = members.join(sizes, "component").withColumn(
        "tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
    )
    rows = members.count()
    wanted = tiled.select("class_id", "key", "copies", "component", "tiles", "tile")
    if rows <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    text = source.join(wanted, source["_id"] == wanted["class_id"]).drop("_id", "class_id")
    large = members.join(sizes.where("tiles > 1"), "component").limit(1).count() > 0
    if large:
        text = stored(text, "texts")
    schema = "u long, v long, n long"
    # A part's hub, its smallest key, is compared with every tile of the part.
    hub = F.col("key") == F.col("component")
    homes = F.when(hub, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("tile"))
    inner = by_group(
        text.withColumn("home", F.explode(homes)).select(
            "component", "home", "key", "copies", F.lit(True).alias("asks"), "_text"
        ),
        ["component", "home"],
        _group_links(length, threshold, "inner" if count_links else ""),
        schema,
    )
    if not large:
        return inner
    if count_links:
        # The hub has met every tile already; all others meet the other tiles of their part.
        pairs = text.where(~hub & (F.col("tiles") > 1)).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        )
        meetings = pairs.where("other <> tile").select(
            "component",
            F.least("tile", "other").alias("low"),
            F.greatest("tile", "other").alias("high"),
            "key",
            "copies",
            (F.col("tile") < F.col("other")).alias("asks"),
            "_text",
        )
        return inner.union(
            by_group(meetings, ["component", "low", "high"], _group_links(length, threshold, "across"), schema)
        )
    inner = stored(inner, "inner")
    merged = components(inner).withColumnRenamed("component", "root")
    big = text.where("tiles > 1")
    state = big.select("component", "key", "tile").join(merged, F.col("key") == F.col("node"), "left")
    open_members = state.where("coalesce(root, key) <> component").select("component", "key", "tile")
    open_tiles = open_members.select("component", F.col("tile").alias("open_tile")).distinct()
    asked = big.join(open_members.select("key"), "key", "left_semi").select(
        "component",
        F.col("tile").alias("open_tile"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("home"),
        "key",
        "copies",
        F.lit(True).alias("asks"),
        "_text",
    )
    met = big.join(open_tiles, "component").select(
        "component", "open_tile", F.col("tile").alias("home"), "key", "copies", F.lit(False).alias("asks"), "_text"
    )
    across = by_group(
        asked.union(met), ["component", "open_tile", "home"], _group_links(length, threshold), schema
    )
    return inner.union(across)


def _text_keys(length: int):
    """Keys of texts' sets, as a column."""

    @F.arrow_udf("long")
    def keys(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            found = [
                set_key(grams)
                for start, stop in words.slices(texts)
                for grams in words.distinct_runs(texts.slice(start, stop - start), length)
            ]
            yield pa.array(found, pa.int64())

    return keys


def one_of_each(
    df: DataFrame,
    threshold: Threshold,
    length: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    null_ids: bool = False,
) -> DataFrame:
    """One row of ``df`` for each component of linked texts, one of the smallest id.

    Whether a row stays is decided by its own text, also where an id is repeated: of several
    texts of the smallest id the one of the least key stays, and one row of it. Texts without
    n-grams link with nothing and stay, once for each id and text. Rows without an id all
    stay; with ``null_ids`` they take part as if they had the largest id.
    """
    row_id = F.col(id_column).cast("bigint")
    if null_ids:
        row_id = F.coalesce(row_id, F.lit(LARGEST_ID))
    source = df.select(row_id.alias("_id"), F.col(text_column).alias("_text"))
    members = stored(join(source, threshold, length, "_id", "_text", with_keys=True).members, "members")
    dropped = members.where("n_shingles > 0 AND (component_id <> _id OR kept_key <> key)")
    repeated = members.where("_id IS NOT NULL").groupBy("_id").count().where("count > 1").limit(1).count()
    if not repeated:
        dropped = stored(dropped.select("_id"), "dropped")
        if dropped.count() <= BROADCAST_ROWS:
            dropped = F.broadcast(dropped)
        whole = df.select(F.struct("*").alias("_row"), row_id.alias("_id"))
        return whole.join(dropped, "_id", "left_anti").select("_row.*")
    dropped = stored(dropped.select("_id", F.col("key").alias("_key")).distinct(), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    empty = ~F.regexp_like(F.coalesce(text_column, F.lit("")), F.lit(NOT_SPACE))
    alone = F.col(id_column).isNull() & (empty if null_ids else F.lit(True))
    # Each row as a whole, so that none of its columns is taken for one of these.
    known = df.where(~alone).select(
        F.struct("*").alias("_row"),
        row_id.alias("_id"),
        _text_keys(length)(F.col(text_column)).alias("_key"),
        F.when(empty, F.coalesce(text_column, F.lit(""))).alias("_empty"),
        (F.col(text_column).isNull()).alias("_null"),
    )
    single = known.dropDuplicates(["_id", "_key", "_empty", "_null"])
    return single.join(dropped, ["_id", "_key"], "left_anti").select("_row.*").unionByName(df.where(alone))
