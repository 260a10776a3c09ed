"""Exact cosine pairs within labels by dual traversal of cover trees.

Unit vectors at cosine t lie sqrt(2 - 2t) apart. A cover tree nests its points in levels: a node has
a centre and a covering radius, and its children's centres lie at least half that radius apart and
cover the node within it. Two nodes whose centres are further apart than both radii and the
threshold distance together hold no pair and are dropped with all below them.

The upper levels are Spark tables: a label's points are dealt to the nearest of a few far-apart
centres until a cell holds ``CELL`` points, and pairs of nodes descend level by level with
equi-joins on the parent's id. The lower levels are built once inside each cell. Pairs of cells that
remain are traversed in tasks, which hand on link counts and stars instead of pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .components import components, star_edges
from .storage import kept

#: Points of a cell.
CELL = 2048
#: Children of a node above the cells, and points that are looked at to choose them.
CHILDREN = 16
SAMPLE = 64
#: Added to pruning bounds: more than rounding can take away, so no pair is lost.
SLACK = 1e-6


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def gap(cosine: np.ndarray) -> np.ndarray:
    """Distance of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class Tree:
    """Cover tree over the rows of ``unit``; node ``n`` has ``point[n]``, ``radius[n]`` and ``children[n]``."""

    def __init__(self, unit: np.ndarray):
        self.unit, self.point, self.radius, self.children = unit, [], [], []
        self.root = self._grow(np.arange(len(unit)), 0)
        self.points, self.radii = np.array(self.point), np.array(self.radius)
        self.leaf = np.array([not len(c) for c in self.children])

    def _node(self, point: int, radius: float) -> int:
        self.point.append(point)
        self.radius.append(radius)
        self.children.append(np.zeros(0, np.int64))
        return len(self.point) - 1

    def _grow(self, rows: np.ndarray, centre: int) -> int:
        away = gap(self.unit[rows] @ self.unit[centre])
        node = self._node(centre, 0.0 if len(rows) == 1 else float(away.max()))
        if len(rows) == 1:
            return node
        if away.max() <= SLACK:  # copies up to rounding: no net separates them
            self.children[node] = np.array([self._node(int(r), 0.0) for r in rows])
            return node
        owner, centres, reach = np.zeros(len(rows), np.int64), [centre], away.max() / 2
        while away.max() > reach:
            far = int(away.argmax())
            more = gap(self.unit[rows] @ self.unit[rows[far]])
            more[far] = 0.0
            closer = more < away
            owner[closer], away = len(centres), np.minimum(away, more)
            centres.append(int(rows[far]))
        self.children[node] = np.array([self._grow(rows[owner == k], c) for k, c in enumerate(centres)])
        return node


def dual_pairs(a: Tree, b: Tree, links, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (of ``a``, of ``b``) that ``links(rows, rows)`` confirms; each once if the trees are the same."""
    left, right, stack = [], [], [(a.root, b.root)]
    while stack:
        i, j = stack.pop()
        one = a.children[i] if len(a.children[i]) else np.array([i])
        two = b.children[j] if len(b.children[j]) else np.array([j])
        away = gap(a.unit[a.points[one]] @ b.unit[b.points[two]].T)
        near = away <= a.radii[one][:, None] + b.radii[two] + reach + SLACK
        if a is b and i == j:
            near = np.triu(near)
        x, y = np.nonzero(near)
        ends = a.leaf[one[x]] & b.leaf[two[y]]
        if a is b and i == j:
            ends_same = ends & (x == y)
            ends = ends & (x != y)
        else:
            ends_same = np.zeros(len(x), bool)
        p, q = a.points[one[x[ends]]], b.points[two[y[ends]]]
        if len(p):
            yes = links(p, q)
            left.append(p[yes])
            right.append(q[yes])
        stack.extend(zip(one[x[~ends & ~ends_same]].tolist(), two[y[~ends & ~ends_same]].tolist()))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _vectors(frame) -> np.ndarray:
    return np.array(frame.tolist(), np.float64)


def _deal(points: DataFrame, cells: DataFrame, cell: int) -> DataFrame:
    """Points of nodes in ``cells`` (node, n) moved to children of these nodes."""
    near = points.join(cells, points["node"] == cells["big"], "left_semi")
    order = Window.partitionBy("node").orderBy(F.xxhash64("class_id"), "class_id")
    some = near.withColumn("__row", F.row_number().over(order)).filter(F.col("__row") <= SAMPLE)
    some = some.groupBy("node").agg(F.collect_list("vector").alias("sample")).withColumnRenamed("node", "of")
    sample = kept(some.join(cells, some["of"] == cells["big"]).select("of", "n", "sample"), "tree-samples")
    schema = points.select("node", "class_id", "copies", "label", "vector").schema

    def choose(sample: np.ndarray, n: int) -> np.ndarray:
        """Far-apart centres: each next one is the farthest from those before."""
        centres, away = [0], gap(sample @ sample[0])
        while len(centres) < min(len(sample), CHILDREN, 2 * -(-n // cell)):
            centres.append(int(away.argmax()))
            away = np.minimum(away, gap(sample @ sample[centres[-1]]))
        return sample[centres]

    def assign(frames):
        known = {}
        for frame in frames:
            for node, rows in frame.groupby("node"):
                if node not in known:
                    if len(known) > 64:
                        known.clear()
                    known[node] = choose(unit_rows(_vectors(rows["sample"].iat[0])), int(rows["n"].iat[0]))
                away = gap(unit_rows(_vectors(rows["vector"])) @ known[node].T)
                away += SLACK * ((rows["class_id"].to_numpy()[:, None] * 2654435761 + np.arange(away.shape[1]) * 40503) % 65521 / 65521)
                rows = rows.assign(node=[f"{node}/{c}" for c in away.argmin(axis=1)])
                yield rows[["node", "class_id", "copies", "label", "vector"]]

    return near.join(sample, near["node"] == sample["of"]).select("node", "class_id", "copies", "label", "vector", "n", "sample").mapInPandas(assign, schema)


def _cells(points: DataFrame, cell: int) -> DataFrame:
    """Points with ``node`` split until no node has more than ``cell``; nodes are paths from the label's root."""
    points = kept(points.withColumn("node", F.concat(F.lit("r"), F.xxhash64("label").cast("string"))), "tree-points")
    done = None
    while True:
        sizes = points.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell)
        big = kept(sizes.withColumnRenamed("node", "big"), "tree-big")
        ready = points.join(big, points["node"] == big["big"], "left_anti")
        done = ready if done is None else done.unionByName(ready)
        if big.isEmpty():
            return done
        points = kept(_deal(points, big, cell), "tree-points")


def linked(vectors: DataFrame, threshold: float = 0.93, cell: int = CELL) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vec_id``, ``embedding``, ``label``.

    Rows link if their labels are equal and not NULL and their cosine, in doubles, is at least ``threshold``
    (above 0). NULL, empty and zero vectors and such with NULL or non-finite components link with nothing, and vectors
    only link with those of their own length. Equal vectors of a label are one point with a number of copies, so
    copies are counted but never paired. A row without ``vec_id`` is counted as a partner but lends no id.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and at most at 1")
    values = F.col("embedding").cast("array<double>")
    rows = kept(vectors.select(F.col("vec_id").cast("long"), F.col("label"), values.alias("vector")), "vectors")
    fine = ~F.exists("vector", lambda x: F.isnull(x) | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = fine & F.exists("vector", lambda x: x != 0)
    good = rows.filter("label is not null and vector is not null").filter(fine)
    keyed = F.struct("label", F.size("vector").alias("dim")).alias("label")
    classes = good.groupBy(keyed, "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = kept(classes.withColumn("class_id", F.monotonically_increasing_id()), "vector-classes")
    cells = _cells(classes.select("class_id", "copies", F.col("label"), "vector"), cell)

    def build(frame):
        import pandas as pd

        frame = frame.sort_values("class_id")
        matrix = _vectors(frame["vector"])
        unit = unit_rows(matrix)
        centre = unit[0]
        narrow = matrix.astype(np.float32)
        kind = "f4" if (narrow == matrix).all() else "f8"
        return pd.DataFrame(
            {
                "node": [frame["node"].iat[0]],
                "dim": [matrix.shape[1]],
                "ids": [frame["class_id"].to_numpy(np.int64).tobytes()],
                "copies": [frame["copies"].to_numpy(np.int64).tobytes()],
                "kind": [kind],
                "matrix": [matrix.astype(kind).tobytes()],
                "centre": [centre.tolist()],
                "radius": [float(gap(unit @ centre).max())],
            }
        )

    cell_schema = "node string, dim int, ids binary, copies binary, kind string, matrix binary, centre array<double>, radius double"
    cells = kept(cells.groupBy("node").applyInPandas(build, cell_schema), "tree-cells")
    partial = kept(_traverse(cells, _cell_pairs(cells, np.sqrt(2 - 2 * threshold)), threshold), "tree-links")

    counts = partial.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "count_of")
    roots = components(partial.filter("b is not null").select("a", "b")).toDF("node", "root")
    joined = classes.join(counts, classes["class_id"] == counts["count_of"], "left").join(roots, classes["class_id"] == roots["node"], "left")
    joined = kept(joined.select("label", "vector", "first", F.coalesce("root", "class_id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-roots")
    ids = joined.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "of")
    named = joined.join(ids, joined["root"] == ids["of"]).select(F.col("label").alias("of_label"), F.col("vector").alias("of_vector"), "n_links", "component_id")
    mine = F.struct("label", F.size("vector").alias("dim"))
    result = rows.join(named, (mine == named["of_label"]) & (rows["vector"] == named["of_vector"]), "left")
    own = F.when(F.col("of_label").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    result = result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _cell_pairs(cells: DataFrame, reach: float) -> DataFrame:
    """Pairs ``a`` <= ``b`` of cells that may hold a link: node pairs descend from the roots, pruned by radius."""
    depth = cells.agg(F.max(F.size(F.split("node", "/")))).first()[0] or 1
    path = F.split("node", "/")
    levels = []
    for level in range(1, depth + 1):
        at = cells.select(F.array_join(F.slice(path, 1, level), "/").alias("node"), "centre", "radius")
        # a node's centre is that of one of its cells; its radius bounds them all
        centre = at.groupBy("node").agg(F.min("centre").alias("c"))
        bound = at.join(centre.withColumnRenamed("node", "of"), F.col("node") == F.col("of"))
        levels.append(bound.groupBy("node").agg(F.first("c").alias("centre"), F.max(F.col("radius") + _gap("c", "centre")).alias("radius")))
    pairs = levels[0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in range(1, depth):
        # a cell above this level is its own child
        child = levels[level].withColumn("parent", F.array_join(F.slice(F.split("node", "/"), 1, level), "/"))
        one, two = child.toDF("a_node", "a_centre", "a_radius", "a_parent"), child.toDF("b_node", "b_centre", "b_radius", "b_parent")
        met = pairs.join(one, pairs["a"] == one["a_parent"]).join(two, pairs["b"] == two["b_parent"])
        met = met.filter((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node")))
        met = met.filter(_gap("a_centre", "b_centre") <= F.col("a_radius") + F.col("b_radius") + F.lit(float(reach) + SLACK))
        pairs = met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    return kept(pairs, "tree-pairs")


def _gap(a: str, b: str):
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def _traverse(cells: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Link counts (``a``, ``n``) and star edges (``a``, ``b``) between classes from all pairs of cells."""
    names = ("dim", "ids", "copies", "kind", "matrix")
    one = cells.select("node", *names).toDF("a_node", *[f"a_{c}" for c in names])
    two = cells.select("node", *names).toDF("b_node", *[f"b_{c}" for c in names])
    work = pairs.join(one, pairs["a"] == one["a_node"]).join(two, pairs["b"] == two["b_node"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
    reach = float(np.sqrt(2 - 2 * threshold))

    def load(batch, side, i):
        value = {c: batch.column(f"{side}_{c}")[i] for c in names}
        matrix = np.frombuffer(value["matrix"].as_buffer(), value["kind"].as_py()).reshape(-1, value["dim"].as_py())
        ids, copies = (np.frombuffer(value[c].as_buffer(), np.int64) for c in ("ids", "copies"))
        return matrix.astype(np.float64), ids, copies

    def run(batches):
        trees = {}

        def tree(node, unit):
            if node not in trees:
                if len(trees) >= 4:
                    trees.pop(next(iter(trees)))
                trees[node] = Tree(unit)
            return trees[node]

        for batch in batches:
            for i in range(batch.num_rows):
                x, x_ids, x_copies = load(batch, "a", i)
                y, y_ids, y_copies = load(batch, "b", i)
                x_norm, y_norm = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
                a_node, b_node = batch.column("a")[i].as_py(), batch.column("b")[i].as_py()
                same = a_node == b_node
                a = tree(a_node, x / x_norm[:, None])
                b = a if same else tree(b_node, y / y_norm[:, None])

                def links(p, q):
                    return np.einsum("ij,ij->i", x[p], y[q]) / (x_norm[p] * y_norm[q]) >= threshold

                p, q = dual_pairs(a, b, links, reach)
                if not len(p):
                    continue
                ids, n = x_ids, np.bincount(p, y_copies[q], len(x)).astype(np.int64)
                more = np.bincount(q, x_copies[p], len(y)).astype(np.int64)
                if same:
                    n, low, other = n + more, *star_edges(p, q, len(x))
                else:
                    ids, n = np.concatenate([x_ids, y_ids]), np.concatenate([n, more])
                    low, other = star_edges(p, q + len(x), len(ids))
                some = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids[some], ids[low]])),
                        pa.array(np.concatenate([np.zeros(len(some), np.int64), ids[other]]), mask=np.r_[np.ones(len(some), bool), np.zeros(len(low), bool)]),
                        pa.array(np.concatenate([n[some], np.zeros(len(low), np.int64)])),
                    ],
                    schema=schema,
                )

    return work.drop("a_node", "b_node").mapInArrow(run, "a long, b long, n long")
