"""A Merkle manifest of a data set with a witness for every row.

A row's leaf is the SHA-256 of its fields.  The leaves of a language, ascending
by id, are the first level of its tree; every ``ARITY`` consecutive nodes become
their hash until one node remains, the language's subroot.  The subroots, ordered
by language, grow the root the same way.

Incremental witnesses.  ``OpenTree`` takes nodes in order, one at a time, and
holds one open run a level.  A node of an open run has the witness known so far;
when the run's last sibling arrives the run completes, each of its subtrees gets
the others' hashes as the next step of its witness, and their parent is appended
one level up.  A block of ``ARITY ** BLOCK_LEVELS`` aligned leaves is one such
stream inside a task, and the block roots are appended to a tree of their own, in
blocks again, until each language has one node; then the subroots.  On the way
back a block takes the witness of its root from the blocks above and continues
those of its own nodes, so no task sees more than a block and no witness of a
single leaf is stored or shuffled.

Positions come from a range partitioning by (language, id, leaf) with counts per
partition, so a language may hold any share of the rows.

Defined results: a null field counts as ``-``; rows without an id come first in
their language and are never tampered with; rows that repeat an id are leaves of
their own, in order of their leaf hashes; a null language is the first one; texts
may be empty or of any length Spark's rows allow (they are hashed in the JVM and
never leave the scan); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import LOWER, UPPER, materialize, sorted_blocks

ARITY = 8
#: Levels of a block: a task holds at most ARITY ** BLOCK_LEVELS nodes at once.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    """H: the hex SHA-256 of the parts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Node:
    """A node of a growing tree; ``parent`` is there once its run is complete."""

    __slots__ = ("hash", "parent", "at", "run", "tail")

    def __init__(self, value: str):
        self.hash = value
        self.parent: Node | None = None
        self.at = 0
        self.run: list[str] = []
        self.tail: str | None = None


class OpenTree:
    """A tree that grows by appends; holds one open run of nodes a level."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[Node]] = [[]]
        self.count = [0]
        self.last: list[Node | None] = [None]

    def append(self, value: str, level: int = 0) -> Node:
        """Appends a leaf (or, at a higher level, the root of a whole subtree)."""
        node = Node(value)
        while level >= len(self.open):
            self.open.append([])
            self.count.append(0)
            self.last.append(None)
        self.open[level].append(node)
        self.count[level] += 1
        self.last[level] = node
        if len(self.open[level]) == self.arity:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        """The run is whole: its subtrees' witnesses grow by one step."""
        nodes, self.open[level] = self.open[level], []
        run = [n.hash for n in nodes]
        parent = self.append(digest(*run), level + 1)
        for at, n in enumerate(nodes):
            n.parent, n.at, n.run = parent, at, run

    def close(self, levels: int | None = None) -> Node:
        """Completes what is open and returns the root: the last node left, or,
        with ``levels``, the node that many levels above the leaves."""
        level = 0
        while not (level == levels or levels is None and self.count[level] == 1):
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.last[level]


def witness(node: Node) -> list[tuple[int, list[str]]]:
    """The steps known so far: (place in its run, hashes of the run) upwards."""
    steps = []
    while node.parent is not None:
        steps.append((node.at, node.run))
        node = node.parent
    return steps


def fold(value: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a node's hash and its witness give."""
    for at, run in steps:
        value = digest(*run[:at], value, *run[at + 1:])
    return value


def siblings(steps: list[tuple[int, list[str]]]) -> str:
    """The other hashes of each run, level by level, left to right."""
    return "".join("".join(run[:at] + run[at + 1:]) for at, run in steps)


def _tail(node: Node, above: str) -> str:
    """The siblings above a node, as text; shared by the nodes of a run."""
    if node.tail is None:
        node.tail = above if node.parent is None else "".join(
            node.run[:node.at] + node.run[node.at + 1:]) + _tail(node.parent, above)
    return node.tail


def _grow(rows: pa.RecordBatch, levels: int) -> tuple[list[Node], Node]:
    """The nodes of a block and its root.  A block that is all of its tree ends
    with the last node left, others go up all levels."""
    tree = OpenTree()
    nodes = [tree.append(h) for h in rows.column("node").to_pylist()]
    alone = rows.column("n")[0].as_py() <= ARITY ** levels
    return nodes, tree.close(None if alone else levels)


def _root_batches(levels: int):
    size = ARITY ** levels

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_blocks(batches, ("name", "block")):
            _, root = _grow(block, levels)
            first = {c: block.column(c)[0].as_py() for c in ("name", "block", "n")}
            yield pa.RecordBatch.from_arrays(
                [pa.array([first["name"]]), pa.array([first["block"]], pa.int64()),
                 pa.array([root.hash]), pa.array([-(-first["n"] // size)], pa.int64())],
                ["name", "pos", "node", "n"])
    return roots


_PATH = "array<struct<at:int,run:array<string>>>"
_ARROW_PATH = pa.list_(pa.struct([("at", pa.int32()), ("run", pa.list_(pa.string()))]))


def _steps(path: list[dict] | None) -> list[tuple[int, list[str]]]:
    return [(s["at"], s["run"]) for s in path or []]


def _witness_batches(levels: int, detail: bool):
    """Continues the witness of each block's root (its first row) to its nodes:
    as paths, or as digests of leaves."""
    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_blocks(batches, ("name", "block")):
            above = _steps(block.column("path")[0].as_py())
            subroot = block.column("subroot")[0].as_py()
            rows = block.slice(1)
            if not rows.num_rows:
                continue
            nodes, _ = _grow(rows, levels)
            if detail:
                found = [[{"at": a, "run": r} for a, r in witness(n) + above] for n in nodes]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("name"), rows.column("pos"), pa.array(found, _ARROW_PATH),
                     pa.array([subroot] * len(nodes), pa.string()), rows.column("doc_id"),
                     rows.column("node"), rows.column("altered")],
                    ["name", "pos", "path", "subroot", "doc_id", "node", "altered"])
                continue
            text = siblings(above)
            proof = [digest(_tail(n, text)) for n in nodes]
            folded = [fold(t or n.hash, witness(n) + above)
                      for n, t in zip(nodes, rows.column("altered").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("node"),
                 pa.array([subroot] * len(nodes), pa.string()), pa.array(proof, pa.string()),
                 pa.array(folded, pa.string())],
                ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])
    return paths


def _in_blocks(rows: DataFrame, levels: int) -> DataFrame:
    return (rows.repartition("name", "block")
            .sortWithinPartitions("name", "block", "pos"))


def _block(levels: int) -> Column:
    return F.floor(F.col("pos") / ARITY ** levels).cast("long").alias("block")


def number_rows(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the position in their group by ``order``, and ``n``,
    the group's size: partitions by range, a running number in each, and the
    counts of the partitions before."""
    ranged = (rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
              .withColumn("at", F.monotonically_increasing_id()))
    ranged = materialize(ranged, name)
    part = F.shiftright("at", 33).alias("part")
    counts = ranged.groupBy(group, part).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    # A row per partition and group: the partitions of a group, and few more.
    w = Window.partitionBy(group)
    counts = counts.select(
        group, "part", "first", F.sum("held").over(w).alias("n"),
        (F.sum("held").over(w.orderBy("part")) - F.col("held")).alias("before"))
    return (ranged.withColumn("part", part).join(counts, [group, "part"])
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
            .drop("part", "first", "before", "at"))


def _rounds(nodes: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """The nodes, the roots of their blocks, the roots of blocks of those, and so
    on, until every name has one node."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rounds.append(materialize(
            _in_blocks(rounds[-1].select("name", _block(levels), "pos", "node", "n"), levels)
            .mapInArrow(_root_batches(levels), "name string, pos long, node string, n long"),
            f"{name}-roots"))
    return rounds


_NO_COLUMNS = {"doc_id": "long", "altered": "string"}


def _descend(rounds: list[DataFrame], top: DataFrame, levels: int, detail: bool, name: str
             ) -> DataFrame:
    """Witnesses of the rows of ``rounds[0]`` from those of the last round (name,
    path, subroot).  Without ``detail`` the last step gives digests."""
    above = top.withColumn("pos", F.lit(0).cast("long"))
    # A round whose names all have one node has the witnesses of ``top``.
    whole = rounds[:-1] if len(rounds) > 1 else rounds
    for k, nodes in reversed(list(enumerate(whole))):
        head = above.select("name", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"),
                            "path", "subroot")
        rows = nodes.select("name", _block(levels), "pos", "node", "n", *(
            F.col(c) if c in nodes.columns else F.lit(None).cast(t).alias(c)
            for c, t in _NO_COLUMNS.items()))
        both = _in_blocks(head.unionByName(rows, allowMissingColumns=True), levels)
        if k == 0 and not detail:
            return both.mapInArrow(
                _witness_batches(levels, False), "doc_id long, leaf string, subroot string, "
                "proof_sha256 string, folded_root string")
        above = both.mapInArrow(
            _witness_batches(levels, True), f"name string, pos long, path {_PATH}, "
            "subroot string, doc_id long, node string, altered string")
        if k:
            above = materialize(above.select("name", "pos", "path", "subroot"), f"{name}-paths")
    return above


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    values = [text if c == "text" else F.col(c) for c in FIELDS]
    return F.sha2(F.concat(*map(_field, values)), 256)


def hash_rows(docs: DataFrame) -> DataFrame:
    """doc_id, name (of the language; orders null first), node (the leaf), altered
    (the leaf after the tampering, where there is any) and salt (which tells
    equal rows apart)."""
    picked = F.crc32(F.col("doc_id").cast("long").cast("string")) % 3 == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("name"),
        _leaf(F.col("text")).alias("node"),
        F.when(picked, _leaf(F.translate("text", UPPER, LOWER))).alias("altered"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"))


def merkle_manifest(docs: DataFrame, detail: bool = False, levels: int = BLOCK_LEVELS
                    ) -> DataFrame:
    """The manifest of ``docs``: doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified of every row.

    With ``detail``: doc_id, leaf, subroot, root and path, the witness itself
    (place in its run and all hashes of the run, from the leaf upwards).
    """
    spark = docs.sparkSession
    leaves = materialize(hash_rows(docs), "leaves")
    numbered = materialize(
        number_rows(leaves, "name", ["doc_id", "node", "salt"], "ordered"), "numbered")
    rounds = _rounds(numbered, levels, "language")
    # A block of its own size may hold a whole tree, so the last round may be the
    # leaves themselves: then every language has one row.
    subroots = rounds[-1].select(F.lit("").alias("all"), "name", F.col("node"))
    placed = materialize(number_rows(subroots, "all", ["name"], "languages"), "subroots")
    forest = _rounds(placed.select(F.lit("").alias("name"), "pos", "node", "n"), levels, "forest")
    top = forest[-1].first()
    root = top["node"] if top else None
    start = spark.range(1).select(
        F.lit("").alias("name"), F.array().cast(_PATH).alias("path"),
        F.lit(None).cast("string").alias("subroot"))
    paths = _descend(forest, start, levels, True, "forest").select("pos", "path")
    tops = placed.join(paths, "pos").select("name", "path", F.col("node").alias("subroot"))
    out = _descend(rounds, materialize(tops, "tops"), levels, detail, "language")
    whole = F.lit(root).cast("string")
    if detail:
        return out.select("doc_id", F.col("node").alias("leaf"), "subroot", whole.alias("root"),
                          "path")
    return out.select("doc_id", "leaf", "subroot", whole.alias("root"), "proof_sha256",
                      "folded_root", (F.col("folded_root") == whole).alias("verified"))
