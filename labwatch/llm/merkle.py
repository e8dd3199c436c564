"""Merkle manifest of a table: a ternary tree per source, a tree over their roots, and a witness of every row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import arrow_explode, stored
from labwatch.llm.jaccard import whole_runs

ARITY = 3
# A block is a subtree of so many levels: 3 ** 7 leaves.
BLOCK_LEVELS = 7
BLOCKS_AT_ONCE = 8


def node_hash(*children: str) -> str:
    """Lower-case hex sha256 of the children's hex texts one after another."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Witnesses:
    """A tree that grows leaf by leaf, and for each leaf the siblings met so far on its way up.

    ``open[l]`` holds the finished nodes of level l whose parent still lacks a sibling, each with the leaves below it.
    When a node's last sibling is there, the parent is made and the witnesses of all leaves below are extended by what
    stands left and right of theirs. A full tree of ``levels`` levels has one root; ``close`` finishes a partial one.
    """

    def __init__(self):
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.paths: list[list[tuple[str, str]]] = []

    def append(self, leaf: str) -> None:
        place = len(self.paths)
        self.paths.append([])
        self._arrived(0, (leaf, place, place + 1))

    def _arrived(self, level: int, node: tuple[str, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self._finished(level)

    def _finished(self, level: int) -> None:
        """The open nodes of a level become their parent, however many they are."""
        run, self.open[level] = self.open[level], []
        names = [name for name, _, _ in run]
        for n, (_, begin, end) in enumerate(run):
            siblings = "".join(names[:n]), "".join(names[n + 1 :])
            for path in self.paths[begin:end]:
                path.append(siblings)
        self._arrived(level + 1, (node_hash(*names), run[0][1], run[-1][2]))

    def close(self, levels: int | None = None) -> str:
        """The root: of exactly ``levels`` levels, or where None of as many as leave one node."""
        level = 0
        while level < len(self.open) if levels is None else level < levels:
            alone = len(self.open[level]) == 1 and not any(self.open[level + 1 :])
            if levels is None and alone:
                break
            if self.open[level]:
                self._finished(level)
            level += 1
        return self.open[level][0][0]


def placed(leaves: DataFrame, group: str, order: list[Column], digest: str, carry: list[str]) -> DataFrame:
    """``group, place, digest, carry``: where each leaf stands in its group, from 0, by ``order``; groups in any order.

    One range sort, in which a group may reach over any number of partitions. Partitions tell the driver their first
    and last group and how many rows these have there: a few values each.
    """
    names = [group, digest, *carry]
    fields = ", ".join(f"`{c}` {leaves.schema[c].dataType.simpleString()}" for c in names)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), object(), 0
        runs = -1
        for batch in batches:
            number, run = [], []
            for value in batch.column(0).to_pylist():
                if value != last:
                    last, count, runs = value, 0, runs + 1
                number.append(count)
                run.append(runs)
                count += 1
            made = [pa.array(v, pa.int64()) for v in (number, run)]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * batch.num_rows, pa.int32()), *made, *columns], names=["part", "number", "run", *names]
            )

    keys = [F.asc_nulls_first(group), *order]
    sorted_rows = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*names)
    rows = stored(sorted_rows.mapInArrow(numbered, f"part int, number long, run long, {fields}"), "leaves")
    ends = rows.groupBy("part").agg(
        F.min(F.struct("run", F.col(group).alias("first"))).alias("first"),
        F.max(F.struct("run", "number", F.col(group).alias("last"))).alias("last"),
    )
    # Two rows' worth per partition of the sort.
    before, offsets, carried = object(), [], 0
    for part in sorted(ends.collect(), key=lambda r: r.part):
        if part.first.first != before:
            carried = 0
        offsets.append((part.part, carried))
        in_part = part.last.number + 1
        carried = in_part + (carried if part.last.run == 0 else 0)
        before = part.last.last
    of_part = F.broadcast(rows.sparkSession.createDataFrame(offsets, "of int, carried long"))
    place = F.col("number") + F.when(F.col("run") == 0, F.col("carried")).otherwise(0)
    return rows.join(of_part, F.col("part") == F.col("of")).select(place.alias("place"), *names)


def blocks_of(leaves: DataFrame, group: str, digest: str, carry: list[str], levels: int = BLOCK_LEVELS) -> DataFrame:
    """``group, block, root, rows``: the leaves' blocks of ``ARITY ** levels``, each a row with its root.

    ``rows`` holds the leaves by place with the columns ``carry``. The block of a group that has only one ends with the
    one node that is left; the last of several is brought up to the level of the others.
    """
    size = ARITY**levels
    fields = ", ".join(f"`{c}`: {leaves.schema[c].dataType.simpleString()}" for c in [digest, *carry])
    row = F.struct(F.col("place"), *[F.col(c) for c in [digest, *carry]])
    gathered = (
        leaves.groupBy(F.col(group), F.floor(F.col("place") / size).cast("long").alias("block"))
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))  # at most ``size`` of them
        .withColumn("rows", F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in [digest, *carry]])))
    )
    kind = leaves.schema[group].dataType.simpleString()
    names = [group, "block", "root", "rows"]

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            digests = batch.column(2).values.field(0).to_pylist()
            bounds = batch.column(2).offsets.to_pylist()
            for n, block in enumerate(batch.column(1).to_pylist()):
                tree = Witnesses()
                for leaf in digests[bounds[n] : bounds[n + 1]]:
                    tree.append(leaf)
                only = block == 0 and bounds[n + 1] - bounds[n] < size
                roots.append(tree.close(None if only else levels))
            columns = [batch.column(0), batch.column(1), pa.array(roots, pa.string()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{group}` {kind}, block long, root string, rows array<struct<{fields}>>"
    return stored(gathered.select(group, "block", "rows").mapInArrow(rooted, schema), "merkle-blocks")


def witnessed(leaves: DataFrame, group: str, order: list[Column], digest: str, carry: list[str], levels: int = BLOCK_LEVELS):
    """The blocks of the leaves and of each level of block roots above, lowest first; the last has one row per group."""
    floors = [blocks_of(placed(leaves, group, order, digest, carry), group, digest, carry, levels)]
    while floors[-1].where("block > 0").limit(1).count():
        above = floors[-1].select(
            group, F.col("block").alias("place"), F.col("root").alias("node"), F.col("block").alias("below")
        )
        floors.append(blocks_of(above, group, "node", ["below"], levels))
    return floors


def _extended(pair: DataFrame, names: list[str], digest: str, carry: list[str], levels: int) -> DataFrame:
    """``names, carry, digest, lefts, rights``: the leaves of blocks (block, rows, lefts, rights), witnesses extended.

    A leaf's witness is its own one up to its block's root, and then the block's.
    """
    rows_type = pair.schema["rows"].dataType.elementType
    fields = ", ".join(f"`{c}` {rows_type[c].dataType.simpleString()}" for c in [digest, *carry])
    narrow = pair.select(*names, "block", "rows", "lefts", "rights")
    first = len(names)

    def leaves(batch: pa.RecordBatch) -> tuple[list[int], list[pa.Array]]:
        blocks = batch.column(first).to_pylist()
        rows = batch.column(first + 1)
        bounds = rows.offsets.to_pylist()
        columns = [rows.values.field(n) for n in range(1 + len(carry))]
        digests = columns[0].to_pylist()
        left_of, right_of = batch.column(first + 2).to_pylist(), batch.column(first + 3).to_pylist()
        at, lefts, rights, offsets = [], [], [], [0]
        for n, block in enumerate(blocks):
            tree = Witnesses()
            for leaf in digests[bounds[n] : bounds[n + 1]]:
                tree.append(leaf)
            tree.close(None if block == 0 and bounds[n + 1] - bounds[n] < ARITY**levels else levels)
            for path in tree.paths:
                at.append(n)
                lefts += [left for left, _ in path] + left_of[n]
                rights += [right for _, right in path] + right_of[n]
                offsets.append(len(lefts))
        inside = [c.slice(bounds[0], bounds[-1] - bounds[0]) for c in columns]
        steps = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(steps, pa.array(side, pa.string())) for side in (lefts, rights)]
        return at, [*inside, *lists]

    added = f"{fields}, lefts array<string>, rights array<string>"
    return arrow_explode(narrow, names, added, leaves, BLOCKS_AT_ONCE)


def _known(floors: list[DataFrame], group: str, levels: int) -> DataFrame:
    """``group, block, lefts, rights, top``: each lowest block's witness up to its group's root, and that root."""
    nothing = F.array().cast("array<string>")
    # One row per group: its root, and no step further.
    known = floors[-1].select(group, "block", nothing.alias("lefts"), nothing.alias("rights"), F.col("root").alias("top"))
    for floor in reversed(floors[1:]):
        made = _extended(_joined(floor, known, group), [group, "top"], "node", ["below"], levels)
        known = stored(made.select(group, F.col("below").alias("block"), "lefts", "rights", "top"), "merkle-paths")
    return known


def _joined(floor: DataFrame, known: DataFrame, group: str) -> DataFrame:
    """Blocks with what is known of their roots."""
    named = known.withColumnsRenamed({group: "_group", "block": "_block"})
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block"))
    return floor.join(named, same).drop("_group", "_block")


def leaf_digest(*fields: str | Column) -> Column:
    """Hex sha256 of fields one after another: ``-`` for null, else the UTF-8 byte count, a colon and the value's text."""
    parts = []
    for field in fields:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def proof_digest(lefts: str = "lefts", rights: str = "rights") -> Column:
    """Hex sha256 of a witness's siblings, level by level, left to right."""
    steps = F.zip_with(lefts, rights, lambda left, right: F.concat(left, right))
    return F.sha2(F.array_join(steps, "").cast("binary"), 256)


def folded(leaf: str | Column, lefts: str = "lefts", rights: str = "rights") -> Column:
    """The root that a leaf's digest and its witness give."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    step = F.arrays_zip(F.col(lefts).alias("l"), F.col(rights).alias("r"))
    return F.aggregate(step, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]).cast("binary"), 256))


def manifest(
    rows: DataFrame, group: str, order: str, digest: str, carry: tuple[str, ...] = (), levels: int = BLOCK_LEVELS
) -> DataFrame:
    """``digest, carry, subroot, root, lefts, rights`` of every row: its witness up to the root over all groups.

    ``rows`` holds a hex digest per row. In each group rows ascend by ``order``, nulls first, then by digest, so equal
    rows may change places without effect. While several nodes remain, every three consecutive ones, and the rest of one
    or two, become the sha256 of their hex texts; what remains is the group's subroot. The subroots by group (null first,
    then bytewise) make the tree of the root likewise. A lone leaf is its own root. ``lefts`` and ``rights`` hold a
    text per level: the siblings' digests on that side, one after another.

    Rows are placed by one range sort and cut into aligned blocks of ``ARITY ** levels``; tasks append a block's leaves to
    ``Witnesses``, block roots are appended to the blocks of the level above, and witnesses are extended on the way down.
    So no group, however large, meets in one task. An empty table gives no row; columns not named are not read.
    """
    needed = [c for c in dict.fromkeys((order, *carry)) if c not in (group, digest)]
    leaves = rows.select(group, digest, *needed)
    by = [F.asc_nulls_first(order), F.asc(digest)] if order != group else [F.asc(digest)]
    floors = witnessed(leaves, group, by, digest, needed, levels)
    subroots = floors[-1].select(F.lit(0).alias("all"), F.col(group).alias("member"), F.col("root").alias("node"))
    tops = witnessed(subroots, "all", [F.asc_nulls_first("member")], "node", ["member"], levels)
    ends = _extended(_joined(tops[0], _known(tops, "all", levels), "all"), ["top"], "node", ["member"], levels)
    ends = stored(ends.withColumnsRenamed({"top": "root_of_all", "lefts": "far_lefts", "rights": "far_rights"}).drop("node"), "merkle-ends")
    known = _known(floors, group, levels).join(ends, F.col(group).eqNullSafe(F.col("member"))).select(
        group,
        "block",
        F.concat("lefts", "far_lefts").alias("lefts"),
        F.concat("rights", "far_rights").alias("rights"),
        F.col("top").alias("subroot"),
        F.col("root_of_all").alias("root"),
    )
    pair = _joined(floors[0].drop("root"), known, group)
    out = _extended(pair, [group, "subroot", "root"], digest, needed, levels)
    return out.select(digest, *carry, "subroot", "root", "lefts", "rights")
