"""Near-duplicates of vectors by a forest of random-projection trees.

Every tree splits its vectors again and again at the median along a random direction, up
to a number of leaves that follows the number of vectors. A vector lives in one leaf per
tree and visits the leaves it comes near: where its projection is within ``spill`` of a
threshold it goes to both sides. Inside a leaf visitors are compared with residents in
double precision by matrix product.

Each link is counted, at both of its ends, in the first tree in which either vector visits the
leaf of the other, so no pair leaves a task: a leaf reports how many links a vector has found,
and one edge per vector to the lead of its part of the leaf.

The trees are fitted on a bounded sample of the vectors; every vector is sent through all
of them. Their number follows from the sample as well: pairs just at the threshold are looked up in
it, and made where its vectors lie densest; trees are added until these pairs meet in some tree, but
for a share too small to matter. Leaves larger than a block are split into pairs of blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.components import connected_components
from tablemill.operators.joins import own_exchange
from tablemill.session import staged
from tablemill.spec import col

COSINE = 0.95
# Trees at least, and the share of links just at the threshold that all trees may miss.
TREES = 8
MISSED = 1e-5
# Vectors of the sample whose neighbours measure this, pairs of them at most (a bounded sample
# for the number of trees alone), and partners made for each of the densest.
PROBES, PROBE_PAIRS, PARTNERS = 4_000, 150_000, 8
# Vectors the trees are fitted on at most, and residents of a leaf aimed at.
SAMPLE = 20_000
LEAF = 512
BLOCK = 2048
ROWS_AT_ONCE = 1000


@dataclass
class Tree:
    """Node ``i`` splits by ``directions[i]`` at ``thresholds[i]`` into ``children[i]``;
    a child below zero is leaf ``-child - 1``."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """A tree whose leaves hold at most ``leaf`` sample vectors, unless a node cannot be
    split (equal projections)."""
    directions, thresholds, children = [], [], []
    leaves = 0

    def build(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            direction = rng.standard_normal(sample.shape[1])
            direction /= np.linalg.norm(direction)
            projected = sample[rows] @ direction
            threshold = float(np.median(projected))
            left = projected < threshold
            if 0 < left.sum() < len(rows):
                node = len(directions)
                directions.append(direction)
                thresholds.append(threshold)
                children.append([0, 0])
                children[node] = [build(rows[left]), build(rows[~left])]
                return node
        leaves += 1
        return -leaves

    build(np.arange(len(sample)))
    d = sample.shape[1]
    return Tree(np.array(directions).reshape(-1, d), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), leaves)


def descend(tree: Tree, vectors: np.ndarray, spill: float):
    """Leaf of every vector, and (vector, leaf) of all visits, the own leaf included."""
    home = np.zeros(len(vectors), np.int64)
    visits = []
    if len(tree.thresholds) == 0:
        rows = np.arange(len(vectors))
        return home, rows, np.zeros(len(rows), np.int64)
    # Groups of (node, vectors, whether the node is on the vector's own way).
    stack = [(0, np.arange(len(vectors)), np.ones(len(vectors), bool))]
    while stack:
        node, rows, own = stack.pop()
        projected = vectors[rows] @ tree.directions[node] - tree.thresholds[node]
        for side, child in enumerate(tree.children[node]):
            mine = (projected < 0) if side == 0 else (projected >= 0)
            go = mine | (np.abs(projected) <= spill)
            if not go.any():
                continue
            if child < 0:
                leaf = -child - 1
                home[rows[mine & own]] = leaf
                visits.append((rows[go], np.full(int(go.sum()), leaf)))
            else:
                stack.append((int(child), rows[go], (own & mine)[go]))
    return home, np.concatenate([a for a, _ in visits]), np.concatenate([b for _, b in visits])


def spanning_edges(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """An edge of every node to the smallest one of its part of the given links."""
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    nodes, ends = np.unique(np.concatenate([x for p in pairs for x in p]), return_inverse=True)
    cut = np.cumsum([len(x) for p in pairs for x in p])
    sides = np.split(ends, cut[:-1])
    u, v = np.concatenate(sides[0::2]), np.concatenate(sides[1::2])
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        if (label == before).all():
            break
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def spill_width(cosine: float, dimensions: int, deviations: float = 0.75) -> float:
    """Width of the zone that goes to both sides: so many standard deviations of the
    difference of two linked vectors along a random direction."""
    return deviations * float(np.sqrt((2 - 2 * cosine) / dimensions))


def probe_pairs(points: np.ndarray, cosine: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of vectors whose cosine is just at the threshold: such as are in the sample, and
    partners made for the quarter of its vectors that have the most neighbours."""
    n = len(points)
    chosen = points[rng.permutation(n)[:PROBES]]
    upper = cosine + (1 - cosine) / 4
    left, right, near = [], [], []
    for start in range(0, len(chosen), 500):
        likeness = chosen[start : start + 500] @ points.T
        near.append((likeness >= 2 * cosine - 1).sum(1))
        i, j = np.nonzero((likeness >= cosine) & (likeness < upper))
        some = rng.permutation(len(i))[: PROBE_PAIRS * 500 // PROBES]
        left.append(chosen[start + i[some]])
        right.append(points[j[some]])
    near = np.concatenate(near)
    dense = np.repeat(chosen[near >= np.quantile(near, 0.75)], PARTNERS, axis=0)
    away = rng.standard_normal(dense.shape)
    away -= (away * dense).sum(1, keepdims=True) * dense
    length = np.linalg.norm(away, axis=1, keepdims=True)
    partners = cosine * dense + np.sqrt(1 - cosine * cosine) * away / np.where(length == 0, 1, length)
    return np.concatenate([*left, dense]), np.concatenate([*right, partners])


def meets(tree: Tree, a: np.ndarray, b: np.ndarray, spill: float) -> np.ndarray:
    """Whether either vector of a pair visits the leaf of the other."""
    home, who, where = descend(tree, a, spill)
    other, whom, there = descend(tree, b, spill)
    visits, back = np.sort(who * tree.leaves + where), np.sort(whom * tree.leaves + there)
    rows = np.arange(len(a))

    def among(taken, wanted):
        at = np.minimum(np.searchsorted(taken, wanted), len(taken) - 1)
        return taken[at] == wanted

    return among(visits, rows * tree.leaves + other) | among(back, rows * tree.leaves + home)


def plant(points: np.ndarray, at_most: int, cosine: float, spill: float, least: int, rng: np.random.Generator) -> list[Tree]:
    """Trees until the probe pairs that never met are a share of at most ``MISSED``."""
    a, b = probe_pairs(points, cosine, rng)
    forest: list[Tree] = []
    apart = np.ones(len(a), bool)
    while len(forest) < least or apart.sum() > MISSED * len(a):
        forest.append(grow(points, at_most, rng))
        if apart.any():
            apart[apart] = ~meets(forest[-1], a[apart], b[apart], spill)
    return forest


def vector_classes(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Rows as ``id``, ``v`` (null if it cannot be linked) and ``k``, a key of ``v``."""
    values = col(vector_column).cast("array<double>")
    good = (
        F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(values, lambda x: x != 0)
    )
    # -0.0 becomes 0.0, so that equal vectors have equal keys.
    v = F.when(F.coalesce(good, F.lit(False)), F.transform(values, lambda x: x + F.lit(0.0)))
    return df.select(col(id_column).cast("long").alias("id"), v.alias("v"))


def vector_links(
    df: DataFrame,
    cosine: float = COSINE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    seed: int = 7,
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite components have no
    links. Equal vectors are linked (each row counts) and compared as one. Vectors of
    different lengths are never linked. A null id is linked where a row with an id has the same
    vector, with nothing otherwise, and names no component. Rows that repeat an id are vectors
    of their own. Other columns are not read.
    """
    rows = staged(vector_classes(df, id_column, vector_column), "vectors")
    classes = (
        rows.where("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        .where("id is not null")
        .select(F.col("id").alias("node"), F.size("v").alias("d"), "v", "copies")
    )
    # Two vectors with one id are two nodes: a number tells them apart.
    classes = staged(
        classes.withColumn("key", F.xxhash64("v")), "classes"
    )
    results, edges = [], []
    for row in classes.groupBy("d").count().orderBy("d").collect():
        found, linked = _forest(classes.where(F.col("d") == row["d"]), row["d"], row["count"], cosine, trees, sample, leaf, seed)
        results.append(found)
        edges.append(linked)
    ident = F.col("id").alias(id_column)
    if not results:
        alone = F.col("id").alias("component_id")
        return rows.select(ident, F.lit(0).cast("long").alias("n_links"), alone, F.lit(True).alias("kept"))
    counted, links = results[0], edges[0]
    for a, b in zip(results[1:], edges[1:]):
        counted, links = counted.unionByName(a), links.unionByName(b)
    components = connected_components(links)
    per_class = (
        classes.join(own_exchange(counted.groupBy("key").agg(F.sum("found").alias("found"))), "key", "left")
        .join(own_exchange(components.withColumnRenamed("component", "c")), "node", "left")
        .select("v", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("c", "node").alias("c"))
    )
    joined = rows.join(own_exchange(per_class.withColumnRenamed("v", "__v")), F.col("v") == F.col("__v"), "left")
    component = F.coalesce("c", "id")
    return joined.select(
        ident,
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def _forest(classes: DataFrame, d: int, count: int, cosine: float, trees: int, sample: int, leaf: int, seed: int):
    """Links found per ``key``, and edges ``a``, ``b`` between nodes."""
    drawn = classes.orderBy("key").limit(sample).select("v").toPandas()["v"]
    points = unit(np.array([np.asarray(v, np.float64) for v in drawn]))
    # The leaf of the sample that makes ``leaf`` of all.
    at_most = max(32, int(leaf * len(points) / max(1, count)))
    rng = np.random.default_rng(seed)
    spill = spill_width(cosine, d)
    forest = plant(points, at_most, cosine, spill, trees, rng)
    first = np.concatenate([[0], np.cumsum([t.leaves for t in forest])])

    def route(batches):
        width = (int(first[-1]) + 7) // 8
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            n = batch.num_rows
            given = np.array(batch.column(2).to_pylist(), np.float64)
            vectors = unit(given)
            # Sent as they came, in single precision if that is what they came in.
            narrow = given.astype(np.float32)
            given = narrow if (narrow == given).all() else given
            homes = np.zeros((n, len(forest)), np.int32)
            seen = np.zeros((n, width * 8), bool)
            who, where = [], []
            for t, tree in enumerate(forest):
                home, rows, leaves = descend(tree, vectors, spill)
                homes[:, t] = home + first[t]
                seen[rows, leaves + first[t]] = True
                who.append(rows)
                where.append(leaves + first[t])
            who, where = np.concatenate(who), np.concatenate(where)
            packed = np.packbits(seen, axis=1, bitorder="little")
            tree_of = np.searchsorted(first, where, side="right") - 1
            for start in range(0, len(who), 20_000):
                r, w = who[start : start + 20_000], where[start : start + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(w.astype(np.int32)), pa.array(homes[r, tree_of[start : start + 20_000]] == w),
                        batch.column(0).take(pa.array(r)), batch.column(1).take(pa.array(r)),
                        batch.column(3).take(pa.array(r)),
                        pa.array([given[i].tobytes() for i in r], pa.binary()),
                        pa.array([homes[i].tobytes() for i in r], pa.binary()),
                        pa.array([packed[i].tobytes() for i in r], pa.binary()),
                    ],
                    names=["leaf", "lives", "key", "node", "copies", "x", "homes", "seen"],
                )

    schema = "leaf int, lives boolean, key long, node long, copies long, x binary, homes binary, seen binary"
    routed = classes.select("key", "node", "v", "copies").mapInArrow(route, schema)
    sizes = routed.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks"))
    routed = routed.join(own_exchange(sizes), "leaf")
    own = F.pmod(F.col("key"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    columns = ["key", "node", "copies", "x", "homes", "seen"]
    # As a visitor a vector meets every block of residents, as a resident every visitor.
    visitors = routed.select("leaf", own.alias("vb"), F.explode(every).alias("rb"), F.lit(True).alias("visits"), *columns)
    residents = routed.where("lives").select(
        "leaf", F.explode(every).alias("vb"), own.alias("rb"), F.lit(False).alias("visits"), *columns
    )

    def compare(table: pa.Table) -> pa.Table:
        visits = table.column("visits").to_numpy()
        a, b = table.filter(pa.array(visits)), table.filter(pa.array(~visits))
        key, node, here = (a.column(c).to_numpy() for c in ("key", "node", "copies"))
        other, others, copies = (b.column(c).to_numpy() for c in ("key", "node", "copies"))
        found, found_there = np.zeros(len(key), np.int64), np.zeros(len(other), np.int64)
        pairs = []
        if a.num_rows and b.num_rows:
            def table_of(t, name, kind):
                return np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(t.num_rows, -1)

            def visited(t):
                return np.unpackbits(table_of(t, "seen", np.uint8), axis=1, bitorder="little")

            def units(t):
                kind = {4 * d: np.float32, 8 * d: np.float64}
                return unit(np.array([np.frombuffer(v, kind[len(v)]) for v in t.column("x").to_pylist()], np.float64))

            x, y = units(a), units(b)
            seen, seen_there = visited(a), visited(b)
            homes, homes_there = table_of(a, "homes", np.int32), table_of(b, "homes", np.int32)
            tree = int(np.searchsorted(first, table.column("leaf")[0].as_py(), side="right")) - 1
            for start in range(0, len(x), 256):
                i, j = np.nonzero(x[start : start + 256] @ y.T >= cosine)
                i += start
                apart = key[i] != other[j]
                i, j = i[apart], j[apart]
                # Where both visit each other's leaf, the pair counts as a visit of the lower key.
                new = (key[i] < other[j]) | (seen_there[j, homes[i, tree]] == 0)
                for t in range(tree):
                    new &= (seen[i, homes_there[j, t]] == 0) & (seen_there[j, homes[i, t]] == 0)
                i, j = i[new], j[new]
                np.add.at(found, i, copies[j])
                np.add.at(found_there, j, here[i])
                pairs.append((node[i], others[j]))
        one, two = spanning_edges(pairs)
        none = np.zeros(len(one), np.int64)
        key, found = np.concatenate([key, other]), np.concatenate([found, found_there])
        hit = found > 0
        key, found = key[hit], found[hit]
        return pa.table({
            "key": np.concatenate([key, none]), "found": np.concatenate([found, none]),
            "a": pa.array(np.concatenate([key * 0, one]), mask=np.arange(len(key) + len(one)) < len(key)),
            "b": np.concatenate([key * 0, two]),
        })

    met = staged(
        visitors.unionByName(residents).groupBy("leaf", "vb", "rb")
        .applyInArrow(compare, "key long, found long, a long, b long"),
        "met",
    )
    return met.where("a is null").select("key", "found"), met.where("a is not null").select("a", "b")
