"""N-gram Jaccard join with parity sketches: equal segments make candidates, folded sketches thin them out, sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import arrow_append, arrow_explode, arrow_map, binary_column, few_of, give_back, stored
from labwatch.llm.components import connected_components
from labwatch.llm.shingles import (
    Bands,
    fold_to,
    folded_sketch,
    segment_keys,
    set_digest,
    shingle_set,
    similar_enough,
)

# Members of one key that a task compares at once; larger keys are compared block by block.
KEY_ROWS = 2048
# Roots that a task remembers as connected; beyond that it begins anew and may hand on more pairs.
ROOTS_AT_ONCE = 1 << 20
# Members of a cluster, and bytes of their sets, that make a block; larger clusters are compared block by block.
BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20
# Elements of sets that are counted at once.
COUNTED_AT_ONCE = 1 << 21
PAIRS_AT_ONCE = 1 << 18


def whole_runs(batches: Iterator[pa.RecordBatch], columns: int, most: int = 1 << 16) -> Iterator[tuple[list[pa.Array], bool]]:
    """Batches sorted by their first ``columns`` cut anew, so that each holds whole runs of equal values.

    Of a run above ``most`` rows parts are handed out, the later ones marked: memory stays bounded.
    """
    held: pa.Table | None = None
    marked = False
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        table = table.combine_chunks()
        keys = np.stack([np.asarray(table.column(i)) for i in range(columns)])
        changes = np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0]
        last = int(changes[-1]) + 1 if len(changes) else 0
        if last:
            yield [c.chunk(0) for c in table.slice(0, last).combine_chunks().columns], marked
            marked = False
        held = table.slice(last)
        if held.num_rows > most:
            yield [c.chunk(0) for c in held.combine_chunks().columns], marked
            # The last row stays, to tell whether the run goes on.
            held, marked = held.slice(held.num_rows - 1), True
    if held is not None and held.num_rows:
        yield [c.chunk(0) for c in held.combine_chunks().columns], marked


def run_starts(keys: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.nonzero(keys[1:] != keys[:-1])[0] + 1))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, node) the keys with at least two nodes, and how many."""
    for (key, node), _ in whole_runs(batches, 1):
        keys, nodes = np.asarray(key), np.asarray(node)
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])))
        keys, nodes = keys[new], nodes[new]
        sizes = np.diff(np.append(run_starts(keys), len(keys)))
        size = np.repeat(sizes, sizes)
        shared = size > 1
        if shared.any():
            columns = [keys[shared], nodes[shared], size[shared].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "size"])


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key the pairs of each later node with the key's first one."""
    last_key, last_hub = None, 0
    for batch in batches:
        keys, nodes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(keys):
            continue
        starts = run_starts(keys)
        hubs = nodes[starts]
        if last_key is not None and keys[0] == last_key:
            hubs[0] = last_hub
        hub = np.repeat(hubs, np.diff(np.append(starts, len(keys))))
        last_key, last_hub = keys[-1], hub[-1]
        pairs = np.unique(np.stack([np.maximum(hub, nodes), np.minimum(hub, nodes)], axis=1)[hub != nodes], axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def close_pairs(
    sizes: np.ndarray, sketches: list[bytes], first: np.ndarray, second: np.ndarray, num: int, den: int
) -> np.ndarray:
    """Which of the pairs of rows may reach the threshold, by their sizes and folded sketches."""
    small, large = np.minimum(sizes[first], sizes[second]), np.maximum(sizes[first], sizes[second])
    keep = small * den >= large * num
    words = np.array([len(s) // 8 for s in sketches])
    wanted = np.minimum(words[first], words[second])
    bound = (small + large) * (den - num) // (den + num)
    for w in np.unique(wanted[keep]).tolist():
        at = np.nonzero(keep & (wanted == w))[0]
        rows, where = np.unique(np.concatenate((first[at], second[at])), return_inverse=True)
        folded = np.stack([fold_to(sketches[r], w) for r in rows.tolist()])
        for part in range(0, len(at), step := max(1, PAIRS_AT_ONCE // w)):
            own = slice(part, part + step)
            a, b = where[: len(at)][own], where[len(at) :][own]
            bits = np.bitwise_count(folded[a] ^ folded[b]).sum(axis=1, dtype=np.int64)
            keep[at[own]] = bits <= bound[at[own]]
    return keep


def run_pairs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of the same run."""
    row = np.concatenate([np.arange(s, e) for s, e in zip(starts.tolist(), ends.tolist())] or [np.zeros(0, np.int64)])
    rest = np.repeat(ends, ends - starts) - row - 1
    first = np.repeat(row, rest)
    before = np.repeat(np.cumsum(rest) - rest, rest)
    return first, first + 1 + np.arange(len(first)) - before


class Joined:
    """Which roots are connected so far, for one task."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def top(self, root: int) -> int:
        while (above := self.above.get(root, root)) != root:
            self.above[root] = root = self.above.get(above, above)
        return root

    def join(self, a: int, b: int) -> bool:
        """Connect two roots; False if they were."""
        a, b = self.top(a), self.top(b)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True


def _bridges(num: int, den: int):
    """Of rows sorted by (key, i, j) pairs of roots with nodes that may link, as few as connect them in the task."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Joined()
        for columns, _ in whole_runs(batches, 3):
            key, i, j, block, root, size = (np.asarray(c) for c in columns[:6])
            sketches = columns[6].to_pylist()
            cell = np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
            starts = np.nonzero(cell)[0]
            ends = np.append(starts[1:], len(key))
            todo = np.cumsum((ends - starts) ** 2) // (4 * PAIRS_AT_ONCE)
            bridges = []
            for part in np.unique(todo).tolist():
                first, second = run_pairs(starts[todo == part], ends[todo == part])
                # A pair of one block belongs to that block's own cell.
                crossing = (root[first] != root[second]) & ((i[first] == j[first]) | (block[first] != block[second]))
                first, second = first[crossing], second[crossing]
                keep = close_pairs(size, sketches, first, second, num, den)
                a, b = root[first[keep]], root[second[keep]]
                for pair in np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0).tolist():
                    if joined.join(*pair):
                        bridges.append(pair)
            if bridges:
                pairs = np.array(bridges, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
            if len(joined.above) > ROOTS_AT_ONCE:
                joined = Joined()
        give_back()

    return found


class _Cell:
    """Members of a cluster that are held against each other: links between different roots, as few as join them."""

    def __init__(self, roots: np.ndarray, sizes: np.ndarray, sketches: list[bytes], sets: list[bytes], num: int, den: int):
        self.num, self.den, self.sizes = num, den, sizes
        self.label = np.unique(roots, return_inverse=True)[1]
        words = np.array([len(s) // 8 for s in sketches])
        # Each width's sketches, folded to it where they are wider.
        self.folded = {
            w: np.stack([fold_to(s, w) if len(s) >= 8 * w else np.zeros(w, np.uint64) for s in sketches])
            for w in np.unique(words).tolist()
        }
        self.words = words
        held = np.concatenate([np.frombuffer(s, "<u8") for s in sets])
        self.flat = np.unique(held, return_inverse=True)[1].astype(np.int32)
        self.ends = np.cumsum(sizes)
        self.seen = np.zeros(int(self.flat.max()) + 1, bool)

    def members_of(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] - self.sizes[i] : self.ends[i]]

    def may_link(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` sizes and folded sketches leave."""
        bound = (self.sizes[i] + self.sizes[others]) * (self.den - self.num) // (self.den + self.num)
        bits = np.zeros(len(others), np.int64)
        width = np.minimum(self.words[others], self.words[i])
        for w in np.unique(width).tolist():
            at = width == w
            matrix = self.folded[w]
            bits[at] = np.bitwise_count(matrix[others[at]] ^ matrix[i]).sum(axis=1, dtype=np.int64)
        return others[bits <= bound]

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` reach the threshold, by the sets themselves."""
        own = self.members_of(i)
        self.seen[own] = True
        out = []
        step = max(1, COUNTED_AT_ONCE // int(self.sizes[others].max()))
        for at in range(0, len(others), step):
            part = others[at : at + step]
            sizes = self.sizes[part]
            hits = self.seen[np.concatenate([self.members_of(j) for j in part.tolist()])]
            shared = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes) - sizes)
            out.append(part[self.den * shared >= self.num * (len(own) + sizes - shared)])
        self.seen[own] = False
        return np.concatenate(out)

    def links(self, apart: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Pairs of rows that link and join two roots; with ``apart`` only pairs that differ in it."""
        order = np.argsort(self.sizes, kind="stable")
        sizes = self.sizes[order]
        last = np.searchsorted(sizes * self.num, sizes * self.den, side="right")
        found = []
        for place, i in enumerate(order.tolist()):
            others = order[place + 1 : last[place]]
            others = others[self.label[others] != self.label[i]]
            if apart is not None:
                others = others[apart[others] != apart[i]]
            if len(others) and len(others := self.may_link(i, others)):
                for j in self.linked(i, others).tolist():
                    if self.label[j] != self.label[i]:
                        found.append((i, j))
                        self.label[self.label == self.label[j]] = self.label[i]
        return found


def _across(num: int, den: int):
    """Of rows sorted by (cluster, i, j) the links that join different roots."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, _ in whole_runs(batches, 3, 1 << 20):
            cluster, i, j, block, node, root, size = (np.asarray(c) for c in columns[:7])
            new = (cluster[1:] != cluster[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            bounds = [0, *(np.nonzero(new)[0] + 1).tolist(), len(cluster)]
            pairs = []
            for begin, end in zip(bounds, bounds[1:]):
                own = slice(begin, end)
                if end - begin < 2 or (root[own] == root[begin]).all():
                    continue
                sketches, sets = (c.slice(begin, end - begin).to_pylist() for c in columns[7:9])
                cell = _Cell(root[own], size[own], sketches, sets, num, den)
                # A pair of one block belongs to that block's own cell.
                pairs += [(begin + a, begin + b) for a, b in cell.links(block[own] if i[begin] != j[begin] else None)]
            if pairs:
                ends = node[np.array(pairs)]
                made = [pa.array(ends.max(axis=1)), pa.array(ends.min(axis=1))]
                yield pa.RecordBatch.from_arrays(made, names=["a", "b"])
        give_back()

    return found


class _Join:
    """One join's inputs: the texts, one row per node, and the parameters."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, size: int, num: int, den: int):
        self.texts, self.nodes, self.size, self.num, self.den = texts, nodes, size, num, den

    def described(self, pairs: DataFrame) -> DataFrame:
        """The pairs that sizes and folded sketches allow, with a text of each node."""
        num, den = self.num, self.den

        def allowed(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            sizes = np.concatenate((np.asarray(batch.column(4)), np.asarray(batch.column(5))))
            sketches = batch.column(6).to_pylist() + batch.column(7).to_pylist()
            row = np.arange(batch.num_rows)
            keep = close_pairs(sizes, sketches, row, row + batch.num_rows, num, den)
            return batch.select([0, 1, 2, 3]).filter(pa.array(keep)) if keep.any() else None

        joined = pairs
        for end in "ab":
            side = self.nodes.select(*[F.col(c).alias(f"{c}_{end}") for c in ("node", "n", "sketch", "text_id")])
            joined = joined.join(side, F.col(end) == F.col(f"node_{end}"))
        narrow = joined.select("a", "b", "text_id_a", "text_id_b", "n_a", "n_b", "sketch_a", "sketch_b")
        return stored(arrow_map(narrow, allowed, "a long, b long, text_id_a long, text_id_b long"), "close-pairs")

    def sets_of(self, needed: DataFrame) -> DataFrame:
        """``text_id, shingles`` of the texts whose ids are ``needed``, once each."""
        passes, size = few_of(needed), self.size

        def shingled(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
            ids = np.asarray(batch.column(0))
            wanted = np.nonzero(passes(ids))[0]
            _, once = np.unique(ids[wanted], return_index=True)
            rows = wanted[once]
            texts = binary_column(batch.take(pa.array(rows)), "text")
            return rows, [pa.array([shingle_set(t, size).tobytes() for t in texts], pa.binary())]

        sets = arrow_explode(self.texts.where("text is not null"), ["text_id"], "shingles binary", shingled, 4096)
        kept = sets.join(needed, F.col("text_id") == F.col("needed"), "left_semi")
        return stored(kept.dropDuplicates(["text_id"]), "shingles")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets reach the threshold."""
        num, den = self.num, self.den

        def linked(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [
                similar_enough(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), num, den) for a, b in zip(left, right)
            ]
            return batch.select([0, 1]).filter(pa.array(keep, pa.bool_())) if any(keep) else None

        close = self.described(pairs)
        if close.isEmpty():
            return close.select("a", "b")
        sets = self.sets_of(close.select(F.explode(F.array("text_id_a", "text_id_b")).alias("needed")).distinct())
        joined = close
        for end in "ab":
            side = sets.select(F.col("text_id").alias(f"of_{end}"), F.col("shingles").alias(f"set_{end}"))
            joined = joined.join(side, F.col(f"text_id_{end}") == F.col(f"of_{end}"))
        return stored(arrow_map(joined.select("a", "b", "set_a", "set_b"), linked, "a long, b long"), "jaccard-links")

    def between(self, rooted: DataFrame) -> DataFrame | None:
        """Links between the roots of ``rooted`` (key, node, root), as many as join them; None where no two may link.

        In keys with several roots, sizes and sketches tell which pairs may link; roots with such pairs form clusters, and
        only pairs that connect them are handed on. Within a cluster all nodes of different roots are held against each
        other, on sketches and then on the sets themselves, and links that join two roots are handed on. So a link between
        two roots is never lost, and no step writes more pairs than it has roots.
        """
        mixed = stored(
            rooted.groupBy(F.col("key").alias("mixed"))
            .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows"))
            .where("low < high")
            .select("mixed", F.ceil(F.col("rows") / F.lit(KEY_ROWS)).cast("int").alias("blocks")),
            "mixed",
        )
        if mixed.isEmpty():
            return None
        meeting = (
            rooted.join(mixed, F.col("key") == F.col("mixed"))
            .join(self.nodes.select(F.col("node").alias("of"), "n", "sketch"), F.col("node") == F.col("of"))
            .select("key", "node", "root", "n", "sketch", "blocks")
        )
        keyed = _in_cells(meeting, F.col("blocks")).select("key", "i", "j", "block", "root", "n", "sketch")
        bridges = stored(_sorted_cells(keyed, "key").mapInArrow(_bridges(self.num, self.den), "a long, b long"), "bridges")
        if bridges.isEmpty():
            return None
        clusters = connected_components(bridges).select(F.col("node").alias("of_root"), F.col("root").alias("cluster"))
        met = rooted.join(mixed, F.col("key") == F.col("mixed"), "left_semi").select("node", "root").distinct()
        members = stored(
            met.join(clusters, F.col("root") == F.col("of_root"))
            .join(self.nodes.withColumnRenamed("node", "of"), F.col("node") == F.col("of"))
            .select("cluster", "node", "root", "n", "sketch", "text_id"),
            "members",
        )
        blocks = members.groupBy(F.col("cluster").alias("large")).agg(
            F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum("n") * 8 / F.lit(BLOCK_BYTES))).cast("int").alias("blocks")
        )
        sets = self.sets_of(members.select(F.col("text_id").alias("needed")).distinct()).withColumnRenamed("text_id", "of_text")
        spread = _in_cells(members.join(blocks, F.col("cluster") == F.col("large")), F.col("blocks"))
        held = spread.join(sets, F.col("text_id") == F.col("of_text"))
        cells = held.select("cluster", "i", "j", "block", "node", "root", "n", "sketch", "shingles")
        return stored(_sorted_cells(cells, "cluster").mapInArrow(_across(self.num, self.den), "a long, b long"), "jaccard-links")


def _in_cells(rows: DataFrame, blocks: Column) -> DataFrame:
    """Rows of a key dealt to blocks by node, once for each pair ``i <= j`` of blocks that theirs is one of."""
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )


def _sorted_cells(cells: DataFrame, key: str) -> DataFrame:
    return cells.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def jaccard_components(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_shingles, component_id, text_id, root`` of every row of ``docs``.

    ``text_id`` is a hash of the row's text, ``root`` one of its group (null without shingles), to join either back.

    A text's set is its distinct shingles of ``size`` words (fewer words: all of them as one). Two sets link when
    ``den * shared >= num * all``; ``component_id`` is the smallest key reachable by links. Equal sets are one node.

    1. Nodes whose parity sketches share a segment meet under its key; every pair that links does.
    2. In each key the node that meets most others is paired with all others: as many pairs as members. Pairs that
       sizes and folded sketches allow are verified on the sets, and links form groups.
    3. In keys that still hold several groups sizes and sketches tell which of these may link: they form clusters. In a
       cluster nodes of different groups are held against each other on sketches and sets, and links that join two groups
       are handed on. Large keys and clusters are compared block by block. So no link between groups is lost, and no more
       pairs are written than there are groups, per pair of blocks.

    Null and empty texts and such without words have no shingle and link with nothing: they keep their own key.
    Null keys take part, but name a component only if no other key is there; repeated rows are rows of their own.
    Sets are compared by 64-bit hashes of their shingles, nodes by a 64-bit hash of the set. Input columns beyond
    the two named ones are not read, so their names don't matter.
    """
    bands = Bands(num, den)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("text_id", F.xxhash64("text"))

    def summarized(batch: pa.RecordBatch) -> list[pa.Array]:
        nodes, sizes, sketches = [], [], []
        for value in binary_column(batch, "text"):
            shingles = shingle_set(value, size)
            sizes.append(len(shingles))
            nodes.append(set_digest(shingles) if len(shingles) else None)
            sketches.append(folded_sketch(shingles, bands) if len(shingles) else None)
        return [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())]

    def keyed(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        keys, nodes, seen = [], [], set()
        for value in binary_column(batch, "text"):
            shingles = shingle_set(value, size)
            node = set_digest(shingles)
            if len(shingles) and node not in seen:
                seen.add(node)
                for band in bands.bands_of(len(shingles)):
                    keys.append(segment_keys(shingles, band, bands))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
        keys, nodes = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (keys, nodes))
        return np.zeros(len(keys), np.int64), [pa.array(keys), pa.array(nodes)]

    rows = stored(
        arrow_append(texts, ["key", "text_id"], "node long, n long, sketch binary", summarized), "shingle-rows"
    )
    nodes = stored(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.min("text_id").alias("text_id"),
            F.min("key").alias("least_key"),
        ),
        "shingle-nodes",
    )
    entries = arrow_explode(texts.select("text"), [], "key long, node long", keyed, 4096)
    meet = stored(
        entries.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_met, "key long, node long, size long"),
        "segments",
    )
    join = _Join(texts.select("text_id", "text"), nodes, size, num, den)

    degree = meet.groupBy("node").agg(F.avg("size").alias("degree")).withColumnRenamed("node", "of")
    ranked = meet.join(degree, F.col("node") == F.col("of")).select("key", "node", "degree")
    starred = ranked.repartition("key").sortWithinPartitions("key", F.desc("degree"), "node").select("key", "node")
    links = join.verified(starred.mapInArrow(_starred, "a long, b long").distinct())

    groups = connected_components(links).withColumnRenamed("node", "of")
    rooted = stored(
        meet.join(groups, F.col("node") == F.col("of"), "left").select(
            "key", "node", F.coalesce("root", "node").alias("root")
        ),
        "rooted",
    )
    more = join.between(rooted)
    components = connected_components(links.unionByName(more)) if more is not None else connected_components(links)
    least = (
        components.join(nodes.select(F.col("node").alias("of"), "least_key"), F.col("node") == F.col("of"))
        .groupBy(F.col("root").alias("of_root"))
        .agg(F.min("least_key").alias("component_id"))
    )
    named = (
        nodes.select("node", "least_key")
        .join(components.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .join(least, F.col("root") == F.col("of_root"), "left")
        .select(
            F.col("node").alias("named"),
            F.coalesce("root", "node").alias("root"),
            F.coalesce("component_id", "least_key").alias("component_id"),
        )
    )
    out = rows.select("key", "node", "n", "text_id").join(named, F.col("node") == F.col("named"), "left")
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        "text_id",
        "root",
    )


def one_of_each(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of linked texts: the one with the smallest key, nulls last.

    Rows without shingles belong to no group and stay. All columns are kept; only rows whose text may have to go
    are shuffled.
    """
    found = stored(jaccard_components(docs.select(key, text), size, num, den, key, text), "groups")
    ranked = found.where("root is not null").select(
        "root", "text_id", F.struct(F.col(key).isNull(), F.col(key), "text_id").alias("rank")
    )
    first = ranked.groupBy("root").agg(F.min("rank").alias("rank"))
    kept = first.select(F.col(f"rank.{key}").alias("kept_key"), F.col("rank.text_id").alias("kept_text"))
    groups = found.groupBy("root").count().where("root is not null and count > 1").select(F.col("root").alias("shared"))
    passes = few_of(found.join(groups, F.col("root") == F.col("shared"), "left_semi").select("text_id").distinct())

    marked = docs.withColumn("_text_id", F.xxhash64(F.col(text)))
    place = len(docs.columns)

    def side(wanted: bool):
        def chosen(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = np.nonzero(passes(np.asarray(batch.column(place))) == wanted)[0]
            return batch.take(pa.array(rows)) if len(rows) else None

        return chosen

    schema = marked.schema
    alone = arrow_map(marked, side(False), schema).drop("_text_id")
    grouped = arrow_map(marked, side(True), schema)
    # A text whose id only looks like a shared one is the only one of its group, or has no shingles.
    empty = found.where("root is null").select(F.col("text_id").alias("bare")).distinct()
    bare = grouped.join(empty, F.col("_text_id") == F.col("bare"), "left_semi")
    same = F.col(key).eqNullSafe(F.col("kept_key")) & (F.col("_text_id") == F.col("kept_text"))
    winners = grouped.join(kept, same, "left_semi").dropDuplicates([key, "_text_id"])
    return alone.unionByName(bare.drop("_text_id")).unionByName(winners.drop("_text_id"))
