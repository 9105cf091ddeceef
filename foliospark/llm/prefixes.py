"""A trie of the prefixes that conversations share.

A turn is the pair of its role and text, told by 16 bytes of its SHA-256; a
conversation is the array of its turns. The arrays are sorted over the whole
table by range. Each task then sweeps its stretch of the order once: the longest
common prefix of neighbours says which open nodes close, a stack holds those
that stay open, and a node's figures go to the node above when it closes.

What a stretch can't know is whether the nodes on the paths of its first and
last row go on in its neighbours. These open stacks, two short paths a task, are
stitched afterwards: parts of one node are summed by a hash of its path, and
sums over subtrees run along each task's paths. Texts never travel; copies of a
conversation, however many, are spread by their conv_id.

Rows: null roles and texts are empty ones; turns go by number, null first, equal
numbers by digest; a row that occurs twice is two turns; rows without a conv_id
belong to no conversation and are left out; other columns are ignored; without a
conversation there is no node, not even the root. A conversation's turns are held
in one row, 24 bytes each, whatever the length of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

#: Open nodes that are looked up by broadcast; beyond that they are joined by key.
BROADCAST_NODES = 100_000
#: Nodes in a batch of rows.
BATCH_NODES = 10_000
WHOLE, UNDER_OPEN, OPEN = 0, 1, 2
SCHEMA = (
    "kind int, task int, slot int, side int, node binary, parent binary, depth bigint, size bigint, "
    "conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string, parent_conv_id bigint"
)
TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
FIELDS = pa.schema([(name, TYPES[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """(lead, conv_id, turns) with turns an array of (digest, size) in order, clustered by ``lead`` = conv_id - conv_id % 5."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    known = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(known, 1, 32)).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    conv = F.col("conv_id").cast("long")
    rows = conversations.filter("conv_id IS NOT NULL").select((conv - conv % 5).alias("lead"), conv.alias("conv_id"), turn.alias("turn"))
    ordered = F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return rows.repartition("lead").groupBy("lead", "conv_id").agg(ordered.alias("turns"))  # one shuffle serves this and rebuilt()


def rebuilt(arrays: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of the conversation ``lead``, then one's own after h; h = crc32(conv_id) % 9."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    lead = F.first(F.when(F.col("conv_id") == F.col("lead"), F.slice("turns", 1, 8)), ignorenulls=True).over(Window.partitionBy("lead"))  # of five at most
    none = F.slice("turns", 1, F.lit(0))
    first = F.slice(F.coalesce(lead, none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return arrays.select("conv_id", F.concat(first, rest).alias("turns"))


class _Node:
    __slots__ = ("children", "conv", "digest", "ends", "id", "leaves", "left", "n", "saved", "size", "slot", "waiting")

    def __init__(self, digest: bytes, above: bytes | None, size: int, left: bool, slot: int):
        self.digest, self.size, self.left, self.slot = digest, size, left, slot
        self.id = above  # made when asked for: the id of the node above
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []
        self.waiting: list[tuple] = []


def _below(node: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(node + digest).digest()[:16]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (path, sizes, conv_id) to rows of nodes."""
    task = TaskContext.get().partitionId()
    stack: list[_Node] = []
    slots = 0
    out: list[tuple] = []

    def ids() -> list[bytes]:
        made = [b""]
        for node in stack[1:]:
            made.append(_below(made[-1], node.digest))
        return made

    def close(right: bool) -> None:
        """Take the deepest node off the stack; ``right``: the stretch is at its end."""
        nonlocal slots
        node, depth = stack.pop(), len(stack)
        above = stack[-1] if stack else None
        if above is not None:
            above.n += node.n
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
        ends = ",".join(map(str, node.ends))
        if node.left or right:
            if not node.left:
                node.slot, slots = slots, slots + 1
            out.extend((UNDER_OPEN, task, node.slot, None, None, None, *row, None) for row in node.waiting)
            path = open_ids[: depth + 1]
            me, parent = path[-1], path[-2] if depth else None
            out.append((OPEN, task, node.slot, 0 if node.left else 1, me, parent, depth, node.size, node.conv, node.n, node.children, node.leaves, node.saved, ends, None))
            if node.left and right:  # on both paths: the right one passes sums on through it
                out.append((OPEN, task, None, 1, me, parent, depth, node.size, node.conv, 0, 0, 0, 0, "", None))
            return
        out.extend((WHOLE, None, None, None, None, None, *row, node.conv) for row in node.waiting)
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
        row = (depth, node.size, node.conv, node.n, node.children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
        if above.left:
            out.append((UNDER_OPEN, task, above.slot, None, None, None, *row, None))
        else:
            above.waiting.append(row)

    def rows() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), FIELDS, strict=True)], schema=FIELDS)
        out.clear()
        return made

    open_ids: list[bytes] = []  # of the first row's path, later of the last row's
    before: list[bytes] = []
    for batch in batches:
        for path, sizes, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            first = not stack
            if first:
                stack.append(_Node(b"", None, 0, True, 0))
                slots = 1
            same = 0
            for a, b in zip(path, before, strict=False):
                if a != b:
                    break
                same += 1
            while len(stack) > same + 1:
                close(False)
            for digest, size in zip(path[same:], sizes[same:], strict=True):
                stack.append(_Node(digest, None, size, first, slots if first else -1))
                slots += first
            if first:
                open_ids = ids()
            top = stack[-1]
            top.n += 1
            top.conv = conv if top.conv is None else min(top.conv, conv)
            top.ends.append(conv)
            before = path
        while len(out) >= BATCH_NODES:
            yield rows()
    if stack:
        open_ids = ids()
    while stack:
        close(True)
    if out:
        yield rows()


def _digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, task, ends): each node's texts in order of tasks, joined by commas, hashed as they stream by."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, made = None, None, []
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != node:
                    if state is not None:
                        made.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
        if state is not None:
            made.append((node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in ((0, pa.binary()), (1, pa.string()))], names=["node", "ends_sha256"])

    dealt = ends.filter("ends <> ''").select("node", "ends", "task").repartition("node").sortWithinPartitions("node", "task")
    return dealt.select("node", "ends").mapInArrow(hashed, "node binary, ends_sha256 string")


def _looked_up(small: DataFrame, nodes: int) -> DataFrame:
    return F.broadcast(small) if nodes <= BROADCAST_NODES else small


def prefix_trie(arrays: DataFrame) -> DataFrame:
    """(conv_id, turns) to a row for each distinct prefix.

    conv_id is the smallest member's, parent_conv_id that of the prefix one turn
    shorter; n_convs counts the members, n_children the prefixes one turn longer,
    n_leaves the childless ones below and including it; saved_tokens sums
    (n_convs - 1) * size of the last turn over the subtree; ends_sha256 is of the
    comma-joined conv_ids of members that end here.
    """
    small_batches(arrays.sparkSession)
    paths = arrays.select(F.col("turns")["digest"].alias("path"), F.col("turns")["size"].alias("sizes"), "conv_id")
    nodes = stored(paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_sweep, SCHEMA))

    parts = stored(nodes.filter(F.col("kind") == OPEN).select("task", "slot", "side", "node", "parent", "depth", "size", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"))
    many = parts.count()
    merged = parts.groupBy("node", "parent", "depth", "size").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("whole_children"), F.min(F.struct("task", "side")).alias("owner")
    )
    merged = stored(merged)
    open_children = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("open_children"))
    merged = stored(merged.join(open_children, "node", "left").withColumn("n_children", F.col("whole_children") + F.coalesce("open_children", F.lit(0))))
    # A node's own share is counted on one of the paths that it is on; what closed below it was counted where it closed.
    own = merged.select("node", "owner", ((F.col("n_convs") - 1) * F.col("size")).alias("own_saved"), (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    joined = parts.select("task", "side", "node", "depth", "n_leaves", "saved").join(own, "node")
    owns = F.col("owner") == F.struct("task", "side")
    sums = joined.select("task", "side", "node", "depth", (F.col("n_leaves") + F.when(owns, F.col("own_leaf")).otherwise(0)).alias("leaves"), (F.col("saved") + F.when(owns, F.col("own_saved")).otherwise(0)).alias("saved"))
    up = Window.partitionBy("task", "side").orderBy(F.desc("depth"))  # one task's path
    totals = sums.select("node", F.sum("leaves").over(up).alias("leaves"), F.sum("saved").over(up).alias("saved")).groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = merged.join(totals, "node").join(_digests(parts), "node", "left").join(above, "parent", "left")
    stitched = whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))

    places = parts.filter("slot IS NOT NULL").select("task", "slot", "node").join(merged.select("node", F.col("conv_id").alias("above")), "node").select("task", "slot", "above")
    closed = nodes.filter(F.col("kind") == WHOLE).select(*_columns("parent_conv_id"))
    under = nodes.filter(F.col("kind") == UNDER_OPEN).join(_looked_up(places, many), ["task", "slot"]).select(*_columns("above"))
    return closed.unionByName(under).unionByName(stitched)


def _columns(parent: str) -> list[Column]:
    return [F.col("conv_id"), F.col("depth"), F.col(parent).alias("parent_conv_id"), *(F.col(c) for c in ("n_convs", "n_children", "n_leaves")), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
