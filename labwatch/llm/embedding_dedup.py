"""Near-duplicate embeddings: a forest of random-projection trees with spill, compared within leaves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import arrow_append, arrow_explode, stored
from labwatch.llm.components import connected_components


class Tree:
    """Inner nodes hold a direction and a cut; a vector within ``spill`` of the cut goes to both sides."""

    def __init__(self, directions: np.ndarray, cuts: np.ndarray, children: np.ndarray, leaves: int, spill: float):
        self.directions, self.cuts, self.children, self.leaves, self.spill = directions, cuts, children, leaves, spill

    def leaves_of(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of every place of every row; a child number below 0 stands for leaf ``-1 - number``."""
        found = []
        stack = [(0 if len(self.cuts) else -1, np.arange(len(matrix)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                found.append((rows, np.full(len(rows), -1 - node)))
            elif len(rows):
                side = matrix[rows] @ self.directions[node] - self.cuts[node]
                stack.append((int(self.children[node, 0]), rows[side <= self.spill]))
                stack.append((int(self.children[node, 1]), rows[side >= -self.spill]))
        return tuple(np.concatenate(part) for part in zip(*found))


def grow_tree(sample: np.ndarray, random: np.random.Generator, spill: float, least: int) -> Tree:
    """Recursive splits at the median along the difference of two random rows, until ``least`` rows are left.

    A node whose children would both keep nearly all its rows is a leaf: a dense group can't be split without
    parting rows that are close.
    """
    directions, cuts, children, leaves = [], [], [], 0
    stack = [(np.arange(len(sample)), -1, 0)]
    while stack:
        rows, parent, side = stack.pop()
        split = None
        if len(rows) > least:
            for _ in range(4):
                a, b = random.choice(rows, 2, replace=False)
                way = sample[a] - sample[b]
                norm = float(np.linalg.norm(way))
                if norm < 1e-9:
                    continue
                along = sample[rows] @ (way / norm)
                cut = float(np.median(along))
                left, right = rows[along <= cut + spill], rows[along >= cut - spill]
                if max(len(left), len(right)) <= 0.85 * len(rows):
                    split = (way / norm, cut, left, right)
                    break
        if split is None:
            number = -1 - leaves
            leaves += 1
        else:
            number = len(cuts)
            directions.append(split[0])
            cuts.append(split[1])
            children.append([0, 0])
            stack += [(split[2], number, 0), (split[3], number, 1)]
        if parent >= 0:
            children[parent][side] = number
    width = sample.shape[1]
    return Tree(
        np.array(directions).reshape(-1, width), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), leaves, spill
    )


def grow_forest(sample: np.ndarray, trees: int, least: int, threshold: float, seed: int) -> list[Tree]:
    """Trees whose spill is two fifths of the half distance that a linked pair of unit vectors can have.

    Along a random direction of d dimensions such a pair differs by about its distance over the square root of d, so
    one tree parts few of them, and all trees part fewer.
    """
    spill = 0.4 * np.sqrt(max(0.0, 2 - 2 * threshold)) / 2
    random = np.random.default_rng(seed)
    return [grow_tree(sample, random, spill, least) for _ in range(trees)]


def _unit(raw: list[bytes]) -> np.ndarray:
    matrix = np.stack([np.frombuffer(r, "<f8") for r in raw])
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def compare_cell(
    left: np.ndarray, right: np.ndarray | None, places: list[np.ndarray], leaf: int, threshold: float
) -> np.ndarray:
    """Which rows of two blocks (or of one) link and meet in no leaf before this one."""
    same = right is None
    links = left @ (left if same else right).T >= threshold
    if same:
        np.fill_diagonal(links, False)
    earlier = np.unique(np.concatenate([p[p < leaf] for block in places for p in block] or [np.zeros(0, np.int64)]))
    if links.any() and len(earlier):
        tables = []
        for block in places:
            seen = np.zeros((len(block), len(earlier)), np.float32)
            for i, p in enumerate(block):
                seen[i, np.searchsorted(earlier, p[p < leaf])] = 1
            tables.append(seen)
        links &= ~(tables[0] @ tables[-1].T > 0)
    return links


def forest_of(links: np.ndarray) -> np.ndarray:
    """The smallest connected row of every row, for a symmetric boolean matrix."""
    root = np.arange(len(links))
    while True:
        near = np.where(links, root[None, :], len(root)).min(axis=1, initial=len(root))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    trees: int = 3,
    sample_rows: int = 20_000,
    leaf_rows: int = 1500,
    block_rows: int = 1500,
    seed: int = 3,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row of ``vectors``.

    Rows link when their labels are equal and not null, their vectors are equally long, and their cosine in double
    precision is at least ``threshold``. Equal vectors of a label are one node with a weight. The forest is grown on
    about ``sample_rows`` nodes chosen by hash; then every node goes to all its leaves, where it is compared with all
    others. A pair counts once, in its first common leaf. Leaves above ``block_rows`` nodes are compared block by
    block, so none is too large for a task, and no node is left out. Pairs that share no leaf in any tree are missed;
    the tests measure how many.

    Null or zero vectors, and those with null or non-finite components, link with nothing: they and rows without a
    label keep themselves. Null keys take part but are nobody's ``component_id``, unless no other is there. Repeated
    rows are rows of their own. ``kept`` says that a row's key is its ``component_id``.
    """

    def checked(batch: pa.RecordBatch) -> list[pa.Array]:
        labels, values = batch.column(1), batch.column(2)
        out = []
        for i, value in enumerate(values):
            raw = None
            if labels[i].is_valid and value.is_valid and len(value) and not value.values.null_count:
                numbers = np.asarray(value.values, np.float64)
                norm = np.linalg.norm(numbers)
                if np.isfinite(numbers).all() and np.isfinite(norm) and norm > 0:
                    raw = (numbers + 0.0).astype("<f8").tobytes()
            out.append(raw)
        return [pa.array(out, pa.binary())]

    chosen = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = stored(
        arrow_append(chosen, ["key", "label"], "raw binary", checked).withColumn(
            "node", F.when(F.col("raw").isNotNull(), F.xxhash64(F.col("label").cast("string"), "raw"))
        ),
        "vectors",
    )
    nodes = stored(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.count("*").alias("weight"), F.min("key").alias("key"), F.first("label").alias("label"), F.first("raw").alias("raw")
        ),
        "nodes",
    )
    widths = [w for (w,) in nodes.groupBy(F.length("raw")).count().select("length(raw)").collect()]
    links = None
    for width in widths:
        found = _links_of_width(
            nodes.where(F.length("raw") == width), threshold, trees, sample_rows, leaf_rows, block_rows, seed
        )
        links = found if links is None else links.unionByName(found)
    if links is None:
        alone = rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    links = stored(links, "leaf-links")
    counted = links.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    components = connected_components(links.where("b is not null").select("a", "b"))
    smallest = (
        components.join(nodes.select("node", "key"), "node")
        .groupBy("root")
        .agg(F.min("key").alias("component_id"))
    )
    per_node = (
        nodes.select("node", "weight", F.col("key").alias("own"))
        .join(counted, "node", "left")
        .join(components, "node", "left")
        .join(smallest, "root", "left")
        .select(
            "node",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component_id", "own").alias("smallest"),
        )
    )
    out = rows.select("key", "node").join(per_node, "node", "left")
    return out.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("smallest")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def _links_of_width(nodes, threshold, trees, sample_rows, leaf_rows, block_rows, seed) -> DataFrame:
    """``a, b, n``: a node's number of linked rows per cell, and links that span each cell's groups."""
    total = nodes.count()
    share = int(min(1.0, sample_rows / max(total, 1)) * (1 << 30))
    picked = nodes.where(F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(1 << 30)) < F.lit(share)).select("raw")
    raws = [bytes(r[0]) for r in picked.collect()]  # about sample_rows vectors
    sample = _unit(raws) if raws else np.zeros((0, 1))
    forest = grow_forest(sample, trees, max(16, int(leaf_rows * len(raws) / max(total, 1))), threshold, seed) if raws else []
    first = np.cumsum([0] + [t.leaves for t in forest])

    def placed(batch: pa.RecordBatch) -> list[pa.Array]:
        matrix = _unit(batch.column(batch.schema.get_field_index("raw")).to_pylist())
        found = [t.leaves_of(matrix) for t in forest] or [(np.arange(len(matrix)), np.zeros(len(matrix), np.int64))]
        row = np.concatenate([r for r, _ in found])
        leaf = np.concatenate([leaf + first[t] for t, (_, leaf) in enumerate(found)])
        order = np.lexsort((leaf, row))
        offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(matrix)))))
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(leaf[order], pa.int64()))]

    # The label splits leaves further; equal raw vectors of two labels are two nodes.
    found = stored(
        arrow_append(nodes, ["node", "weight", "raw", "label"], "leaves array<long>", placed), "leaves"
    ).withColumn("leaf", F.explode("leaves"))
    sizes = found.groupBy("label", "leaf").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    sizes = sizes.select(F.col("label").alias("of_label"), F.col("leaf").alias("of_leaf"), "blocks")
    split = found.join(sizes, (F.col("label") == F.col("of_label")) & (F.col("leaf") == F.col("of_leaf")))
    block = F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = split.withColumn("block", block).withColumn("other", other).select(
        "node", "weight", "raw", "leaves", "label", "leaf", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )

    def compared(key, table):
        leaf, i, j = (key[n].as_py() for n in (1, 2, 3))
        nodes_, weights = np.asarray(table["node"]), np.asarray(table["weight"])
        unit = _unit(table["raw"].to_pylist())
        places = [np.array(p) for p in table["leaves"].to_pylist()]
        own = np.asarray(table["block"])
        if i == j:
            links = compare_cell(unit, None, [places], leaf, threshold)
        else:
            at = [np.nonzero(own == b)[0] for b in (i, j)]
            if not (len(at[0]) and len(at[1])):
                return LINKS.empty_table()
            parts = [[places[n] for n in block] for block in at]
            links = np.zeros((len(unit), len(unit)), bool)
            links[np.ix_(*at)] = compare_cell(unit[at[0]], unit[at[1]], parts, leaf, threshold)
            links |= links.T
        sums = links @ weights
        some = np.nonzero(sums)[0]
        a, b = nodes_[some], nodes_[forest_of(links)[some]]
        return pa.table([pa.array(a), pa.array(b, mask=a == b), pa.array(sums[some])], schema=LINKS)

    return cells.groupBy("label", "leaf", "i", "j").applyInArrow(compared, "a long, b long, n long")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
