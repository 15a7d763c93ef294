"""Prefix trie of conversations, by union-find over sorted neighbours.

A conversation is a path: the 128-bit digests of its turns, end to end. Paths are sorted
over all tasks, with ids breaking ties, so copies spread. In a block of sorted paths every
edge between neighbours carries the length of their common prefix. Edges are taken from
the deepest up: the paths on both sides of an edge join one component, and the merge makes
(or adds a branch to) the node at that depth. Whatever hangs below an edge is then
complete and folds into its totals.

Only the first and the last path of a block can go on outside it. So a block's forest
contracts to these two paths, with the totals that hang off each of their nodes. They are
items like any others: a task merges them with its next block, and the forests of
neighbouring tasks are merged across their boundaries in rounds, some at a time, until one
is left. No task holds more than a block, or the contracted forests of a few tasks, at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import filled

#: Paths and bytes of paths merged at once, and forests of neighbouring tasks in a round.
BLOCK, BLOCK_BYTES, FOREST_GROUP = 20_000, 16 << 20, 64
_TURN = 16  # bytes of a turn's digest

_NODE = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("key", pa.binary()), ("parent_key", pa.binary()),
]
_PIECE = [("first", pa.int64()), ("ids", pa.string())]
_TOTALS = ("depths", "n", "least", "children", "leaves", "saved")
_SPINE = [("part", pa.int64()), ("side", pa.int32()), ("path", pa.binary()), ("chars", pa.list_(pa.int64()))] + [(x, pa.list_(pa.int64())) for x in _TOTALS]
_ROW = pa.schema([*_NODE, *_PIECE, *_SPINE])
_SQL_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<bigint>"}
_ROW_SQL = ", ".join(f"`{f.name}` {_SQL_TYPES[f.type]}" for f in _ROW)


class _Node:
    """Totals of a node: all below it that is complete, and conversations that end there."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "ids", "open", "below")

    def __init__(self, n=0, least=None, children=0, leaves=0, saved=0, ids=None, open_=False):
        self.n, self.least, self.children, self.leaves, self.saved = n, least, children, leaves, saved
        self.ids: list[int] = ids or []
        self.open = open_  # some part of it has been in a contracted forest
        self.below: list[dict] = []  # finished children that don't know this node's conv_id

    def add(self, other: "_Node") -> None:
        self.n += other.n
        self.least = other.least if self.least is None else self.least if other.least is None else min(self.least, other.least)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ids += other.ids
        self.open |= other.open
        self.below += other.below


class _Path:
    """An item of a block: a conversation, or a side of a contracted forest."""

    __slots__ = ("path", "chars", "nodes")

    def __init__(self, path: bytes, chars: list[int], nodes: dict[int, _Node]):
        self.path, self.chars, self.nodes = path, chars, nodes

    @property
    def depth(self) -> int:
        return len(self.path) // _TURN


def _common(a: bytes, b: bytes) -> int:
    """How many turns two paths share from the start."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // _TURN
    differ = np.frombuffer(a[:size], np.uint8) != np.frombuffer(b[:size], np.uint8)
    return int(differ.argmax()) // _TURN


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.md5(path[: depth * _TURN]).digest()


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _merged(items: list[_Path], whole: bool, rows: list[dict]) -> list[_Path]:
    """The contracted forest of sorted items; what is finished goes to ``rows``. With
    ``whole`` nothing follows or precedes the items and everything is finished."""
    last = len(items) - 1
    shared = [-1] + [_common(a.path, b.path) for a, b in zip(items, items[1:])]
    # To which depth an item's nodes lie on the last path too.
    ahead = [items[last].depth] * (last + 1)
    for i in range(last - 1, -1, -1):
        ahead[i] = min(shared[i + 1], ahead[i + 1])
    root = list(range(last + 1))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sides: tuple[dict[int, _Node], dict[int, _Node]] = ({}, {})
    for i in sorted(range(last + 1), key=lambda i: (-shared[i], i)):
        item, done = items[i], None
        for depth in range(item.depth, shared[i], -1):
            node = item.nodes.pop(depth, None) or _Node()
            if done:
                node.add(done)
            if not whole and (i == 0 or depth <= ahead[i]):
                done = None
                sides[i > 0][depth] = node
                _put_off(node, _key(item.path, depth), rows)
            else:
                done = _finished(node, item, depth, rows)
        if i == 0:
            break
        # The edge to the left neighbour: its component's first path holds the node.
        owner = find(i - 1)
        root[i] = owner
        if done:
            item.nodes.setdefault(shared[i], _Node()).add(done)
        for depth, node in item.nodes.items():
            items[owner].nodes.setdefault(depth, _Node()).add(node)
    if whole:
        return []
    left, right = [_Path(items[i].path, items[i].chars, nodes) for i, nodes in zip((0, last), sides)]
    return [left, right] if right.nodes else [left]


def _finished(node: _Node, item: _Path, depth: int, rows: list[dict]) -> _Node:
    """Reports a complete node; returns what it adds to its parent's totals."""
    key = _key(item.path, depth) if node.open else None
    node.leaves = node.leaves or 1
    node.saved += (node.n - 1) * item.chars[depth - 1] if depth else 0
    row = {"conv_id": node.least, "depth": depth, "n_convs": node.n, "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved, "key": key}
    if key is None:
        row["ends_sha256"] = hashlib.sha256(_joined(node.ids).encode()).hexdigest()
    elif node.ids:
        rows.append({"key": key, "first": node.ids[0], "ids": _joined(node.ids)})
    for child in node.below:
        child["parent_conv_id"] = node.least
    rows.append(row)
    up = _Node(node.n, node.least, 1, node.leaves, node.saved)
    up.below = [row]
    return up


def _put_off(node: _Node, key: bytes, rows: list[dict]) -> None:
    """Leaves a node for a later merge: ids that end there and finished children wait for
    it by its key."""
    node.open = True
    if node.ids:
        rows.append({"key": key, "first": node.ids[0], "ids": _joined(node.ids)})
        node.ids = []
    for child in node.below:
        child["parent_key"] = key
    node.below = []


def _written(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ROW)


def _spines(paths: list[_Path], part: int) -> list[dict]:
    out = []
    for side, x in enumerate(paths):
        nodes = sorted(x.nodes.items())
        totals = zip(*[(d, v.n, v.least, v.children, v.leaves, v.saved) for d, v in nodes])
        out.append({"part": part, "side": side, "path": x.path, "chars": x.chars, **dict(zip(_TOTALS, map(list, totals)))})
    return out


def _read(rows: Iterable[dict]) -> list[_Path]:
    out = []
    for row in rows:
        totals = zip(*[row[x] for x in _TOTALS])
        out.append(_Path(row["path"], row["chars"], {d: _Node(n, least, c, l, s, open_=True) for d, n, least, c, l, s in totals}))
    return out


def _first_forests(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """A task's sorted conversations, block by block, to one contracted forest."""
    items: list[_Path] = []
    rows: list[dict] = []
    size = 0
    for batch in batches:
        for conv_id, path, chars in zip(*[batch[x].to_pylist() for x in ("conv_id", "path", "chars")]):
            items.append(_Path(path, chars, {len(path) // _TURN: _Node(1, conv_id, ids=[conv_id])}))
            size += len(path)
            if len(items) > block or size > BLOCK_BYTES:
                items, size = _merged(items, False, rows), 0
                yield _written(rows)
                rows.clear()
    if items:
        forest = _merged(items, False, rows)
        yield _written(rows + _spines(forest, TaskContext.get().partitionId()))


def sequences(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest and code points.

    Null turns come first; of one turn number, turns are ordered by role, then digest. Null
    roles and texts are empty. Rows without conv_id belong to no conversation. A whole
    conversation is one row: some 50 bytes a turn.
    """
    role, text = filled(F.col(f"`{role_col}`")), filled(F.col(f"`{text_col}`"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text))
    turn = F.col(f"`{turn_col}`")
    one = F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), one.alias("one")).filter("conv_id IS NOT NULL")
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    return ordered.select("conv_id", F.transform("all", lambda x: F.struct(x["digest"].alias("digest"), x["chars"].alias("chars"))).alias("turns"))


def with_shared_heads(convs: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Conversations rebuilt from the first ``head`` turns (``most`` at most) of the
    conversation ``base``, where there is one, and their own turns after as many."""
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    own = convs.withColumns({"base": base, "head": head}).join(heads, "base", "left")
    kept = F.coalesce(F.slice("first", F.lit(1), F.col("head")), F.expr("slice(turns, 1, 0)"))
    rest = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.select("conv_id", F.concat(kept, rest).alias("turns"))


def prefix_trie(convs: DataFrame, block: int = BLOCK, group: int = FOREST_GROUP) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id, turns), the empty one
    included: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves (childless nodes in its subtree), saved_tokens (over its subtree, each node's
    n_convs - 1 times its last turn's code points) and ends_sha256 (of the ids that end
    there, ascending and comma-joined).

    conv_id must be distinct. Conversations without turns (empty array) belong to the root
    alone. Copies are members of the same nodes. No conversations: no rows.
    """
    paths = convs.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.chars").alias("chars"))
    paths = materialize(paths, "paths")
    order = ["path", "conv_id"]
    ranged = paths.repartitionByRange(*order).sortWithinPartitions(*order)
    found = [materialize(ranged.mapInArrow(lambda batches: _first_forests(batches, block), _ROW_SQL), "forests")]
    while True:
        forests = found[-1].filter("part IS NOT NULL").select("part", "side", "path", "chars", *_TOTALS)
        top = forests.agg(F.max("part")).first()[0]
        if top is None:
            break
        whole = top < group

        def across(table: pa.Table) -> pa.Table:
            table = table.sort_by([("part", "ascending"), ("side", "ascending")])
            rows: list[dict] = []
            forest = _merged(_read(table.to_pylist()), whole, rows)
            return pa.Table.from_batches([_written(rows + _spines(forest, table["part"][0].as_py() // group))])

        grouped = forests.groupBy(F.expr(f"part DIV {group}").alias("group"))
        found.append(materialize(grouped.applyInArrow(across, _ROW_SQL), "forests"))
        if whole:
            break
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    nodes = rows.filter("conv_id IS NOT NULL")
    late = nodes.filter("key IS NOT NULL")
    parents = late.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("late_parent"))
    pieces = rows.filter("ids IS NOT NULL").select("key", "first", "ids")
    late = late.join(_ends(pieces), "key", "left").withColumn("ends_sha256", F.coalesce("late_ends", F.sha2(F.lit(b""), 256)))
    named = nodes.filter("key IS NULL").unionByName(late.drop("late_ends"))
    named = named.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "late_parent"))
    return named.select(*[name for name, _ in _NODE if not name.endswith("key")])


def _ends(pieces: DataFrame) -> DataFrame:
    """(key, late_ends): digests of lists written in pieces, each streamed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for own, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
                if own != key:
                    if key is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "late_ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "late_ends"])

    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(run, "key binary, late_ends string")
