"""Prefix trie of conversations in balanced parentheses.

Turns become 128-bit digests, a conversation the string of its turns' digests.
Strings are range-partitioned in order, with the conversation ids behind them, so
that copies of one conversation or of one first turn spread over shards. A shard
writes its trie as balanced parentheses, in the order of the strings:

* blocks with their smallest and largest excess, in a tree, find the closing
  parenthesis of every node (``findclose``), which delimits its subtree;
* the number of pairs ``()`` up to a place (rank) gives leaves of subtrees;
* cumulative arrays over nodes and over ending conversations give members and
  texts, and with them what shared prefixes save.

Nodes on the paths of a shard's first and last string may also lie in other
shards. These spines are keyed by a 128-bit hash of their prefix and merged: sums
are added, and what several shards hold (the nodes of a shared path) is taken
off where it repeats. A shard has two spine rows for each turn of two
conversations, so the merge sees few rows.

``saved_tokens`` of a node follows from sums: over its members the texts from
the node's depth on, less every text of a node of its subtree once.

Defined cases: a null role or text is empty. Turns are ordered by number (null
first), then role, then the MD5 of role and text, so repeated turns follow one
another and each counts. Rows without a conversation id belong to none. A
conversation is one row of 24 bytes for each turn, whatever its texts' length.
An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.jobs import record, stage, task_number

DIGEST = 16
#: Turns of a shard at most, and at least where there are idle tasks.
SHARD_TURNS, LEAST_TURNS = 1 << 19, 1 << 12
#: Parentheses of a block of the excess tree; ids of a piece of a hashed list.
BLOCK = 16
PIECE_IDS = 1 << 16


def _digest(role: str, text: str) -> Column:
    """Of role and text; the length keeps the two apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def conversations(
    turns: DataFrame, group: Column, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``group, conv, turns``: a row for each conversation with its turns in order, as (digest, bytes).

    All conversations of a ``group`` come to one partition. Texts are not shuffled.
    """
    named = turns.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), group.alias("group"),
    ).where("conv IS NOT NULL")
    small = named.select(
        "group", "conv", "turn", "role", _digest("role", "text").alias("digest"), F.octet_length("text").cast("long").alias("bytes")
    )
    order = Window.partitionBy("group", "conv").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    placed = small.repartition("group").select("group", "conv", F.row_number().over(order).alias("at"), "digest", "bytes")
    rows = placed.groupBy("group", "conv").agg(F.array_sort(F.collect_list(F.struct("at", "digest", "bytes"))).alias("turns"))
    return rows.select("group", "conv", F.transform("turns", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def respliced(turns: DataFrame, block: int = 5, heads: int = 9, conv_col: str = "conv_id") -> DataFrame:
    """Conversations whose first ``h`` turns are those of the first one of their block of ids.

    ``h`` is the CRC-32 of the decimal id modulo ``heads``. Remainders are SQL's
    (negative for negative ids).
    """
    conv = F.col(conv_col).cast("long")
    own = conversations(turns, conv - conv % block, conv_col)
    # A block has few conversations, and of the donor at most heads - 1 turns are used.
    donor = F.max(F.when(F.col("conv") == F.col("group"), F.slice("turns", 1, heads - 1))).over(Window.partitionBy("group"))
    h = (F.crc32(F.col("conv").cast("string")) % heads).cast("int")
    head = F.slice(F.coalesce(F.col("donor"), F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.withColumns({"donor": donor, "h": h}).select("conv", F.concat(head, tail).alias("turns"))


class Parens:
    """Balanced parentheses with range minima and maxima of the excess."""

    def __init__(self, open_: np.ndarray):
        self.open = open_
        self.excess = np.cumsum(np.where(open_, 1, -1))
        blocks = -(-len(open_) // BLOCK)
        # The padding is never below a target and never equal to one.
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: len(open_)] = self.excess
        self.levels = [padded.reshape(blocks, BLOCK)]
        low = self.levels[0].min(axis=1)
        high = np.where(self.levels[0] == padded.max(), -1, self.levels[0]).max(axis=1) if len(open_) else low
        self.low, self.high = [low], [high]
        while len(self.low[-1]) > 1:
            low, high = self.low[-1], self.high[-1]
            if len(low) % 2:
                low, high = np.append(low, np.iinfo(np.int64).max), np.append(high, -1)
            self.low.append(low.reshape(-1, 2).min(axis=1))
            self.high.append(high.reshape(-1, 2).max(axis=1))

    def close(self, at: np.ndarray) -> np.ndarray:
        """For each opening parenthesis the closing one: the next place where the excess is one less."""
        target = self.excess[at] - 1
        found = np.full(len(at), -1)
        # First in the rest of the own block.
        block = at // BLOCK
        for step in range(1, BLOCK):
            left = np.flatnonzero((found < 0) & (at % BLOCK + step < BLOCK) & (at + step < len(self.excess)))
            place = at[left] + step
            hit = self.excess[place] == target[left]
            found[left[hit]] = place[hit]
        todo = np.flatnonzero(found < 0)
        # Then up the tree to the first later node whose range holds the target, and down to its first such block.
        node, level = block[todo], np.zeros(len(todo), np.int64)
        climbing = np.ones(len(todo), bool)
        for k in range(len(self.low)):
            up = np.flatnonzero(climbing)
            if not len(up):
                break
            right = node[up] + 1
            inside = (node[up] % 2 == 0) & (right < len(self.low[k])) if k + 1 < len(self.low) else np.zeros(len(up), bool)
            right = np.where(inside, right, 0)
            want = target[todo[up]]
            hit = inside & (self.low[k][right] <= want) & (want <= self.high[k][right])
            node[up[hit]], level[up[hit]] = right[hit], k
            climbing[up[hit]] = False
            node[up[~hit]] //= 2
        assert not climbing.any(), "parentheses are not balanced"
        for k in range(len(self.low) - 1, 0, -1):
            down = np.flatnonzero(level == k)
            child, want = node[down] * 2, target[todo[down]]
            hit = (self.low[k - 1][child] <= want) & (want <= self.high[k - 1][child])
            node[down], level[down] = np.where(hit, child, child + 1), k - 1
        if len(todo):
            found[todo] = node * BLOCK + (self.levels[0][node] == target[todo][:, None]).argmax(axis=1)
        return found


def common_turns(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Leading turns that each string shares with its predecessor (0 for the first one)."""
    size = np.diff(first)
    both = np.minimum(size[1:], size[:-1])
    pair = np.repeat(np.arange(len(both)), both)
    at = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    differ = np.flatnonzero((keys[first[pair] + at] != keys[first[pair + 1] + at]).any(axis=1))
    shared = both.copy()
    np.minimum.at(shared, pair[differ], at[differ])
    return np.append(0, shared)


def _range_min(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Smallest of ``values[k : k + size[k]]`` for each k, from minima of doubling lengths."""
    out, table, length = values.copy(), values, 1
    while True:
        mine = np.flatnonzero((size >= length) & (size < 2 * length))
        last = mine + size[mine] - length
        out[mine] = np.minimum(table[mine], table[last])
        if not (size >= 2 * length).any():
            return out
        table = np.minimum(table[: len(table) - length], table[length:])
        length *= 2


@dataclass
class Shard:
    """Nodes of the trie of sorted strings, in the order of their opening parentheses."""

    parens: Parens
    depth: np.ndarray
    parent: np.ndarray  # node number; the root's is -1
    end: np.ndarray  # node where each distinct string ends
    members: np.ndarray
    smallest: np.ndarray
    texts: np.ndarray  # bytes of the subtree's nodes, each once
    weighted: np.ndarray  # bytes of whole member conversations
    before: np.ndarray  # bytes on the path above the node
    own: np.ndarray  # bytes of the node's text
    leaves: np.ndarray
    children: np.ndarray


def encode(keys: np.ndarray, size_bytes: np.ndarray, first: np.ndarray, shared: np.ndarray, copies: np.ndarray, least: np.ndarray) -> Shard:
    """Trie of distinct strings: digests and bytes of all turns, first turn of each, turns shared, members, smallest id."""
    size = np.diff(first)
    opened = size - shared
    opened[0] += 1  # the root
    closed = np.append(0, size[:-1] - shared[1:])
    counts = np.append(np.column_stack([closed, opened]).ravel(), size[-1] + 1)
    parens = Parens(np.repeat(np.arange(len(counts)) % 2 == 1, counts))
    place = np.flatnonzero(parens.open)
    close = parens.close(place)
    nodes = (close - place + 1) // 2
    depth = parens.excess[place] - 1
    n = len(place)
    pairs = np.cumsum(parens.open & np.append(~parens.open[1:], False))
    leaves = pairs[close] - pairs[place] + (~parens.open[place + 1])
    # A node's parent is the last node before it that is one less deep.
    by_depth = np.sort(depth * n + np.arange(n))
    parent = by_depth[np.searchsorted(by_depth, (depth - 1) * n + np.arange(n)) - 1] % n
    parent[0] = -1
    end = np.cumsum(opened) - 1
    # The turn that each node stands for; the root has none.
    string = np.repeat(np.arange(len(size)), opened)
    turn = first[string] + depth - 1
    own = np.append(0, size_bytes[turn[1:]])
    running = np.append(0, np.cumsum(size_bytes))
    before = running[turn] - running[first[string]]
    before[0] = 0

    def below(values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        return total[np.arange(n) + nodes] - total[:n]

    def at_end(values: np.ndarray, missing: int = 0) -> np.ndarray:
        out = np.full(n, missing, np.int64)
        out[end] = values
        return out

    whole = running[first[1:]] - running[first[:-1]]
    return Shard(
        parens, depth, parent, end, below(at_end(copies)), _range_min(at_end(least, np.iinfo(np.int64).max), nodes), below(own),
        below(at_end(copies * whole)), before, own, leaves, np.bincount(parent[1:], minlength=n),
    )


_SHARD = """shard int, side int, last boolean, depth long, node binary, conv_id long, n_convs long, texts long, weighted long,
before long, own long, n_leaves long, n_children long, parent_conv long, parent_side int, ends string, piece int, ids binary"""
_INTERIOR, _FIRST, _LAST = 0, 1, 2
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _path_hashes(keys: np.ndarray) -> list[bytes]:
    """128-bit hash of every prefix of a string, the empty one included."""
    h, out = hashlib.blake2b(digest_size=16), []
    out.append(h.digest())
    for digest in keys:
        h.update(digest.tobytes())
        out.append(h.copy().digest())
    return out


def _id_list(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node rows, and pieces of id lists, of the shard whose sorted strings a task reads."""
    full = [b for b in batches if b.num_rows]
    if not full:
        return
    table, shard = pa.Table.from_batches(full).combine_chunks(), task_number()
    conv = table.column("conv").to_numpy()
    key = table.column("key").combine_chunks().cast(pa.large_binary())
    _, offsets, data = key.buffers()
    offsets = np.frombuffer(offsets, np.int64)[key.offset : key.offset + len(key) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    keys = data[offsets[0] : offsets[-1]].reshape(-1, DIGEST)
    first = (offsets - offsets[0]) // DIGEST
    size_bytes = table.column("bytes").combine_chunks().flatten().to_numpy()
    shared, size = common_turns(keys, first), np.diff(first)
    new = np.append(True, (shared[1:] < size[1:]) | (size[1:] != size[:-1]))
    start = np.flatnonzero(new)
    copies, size = np.diff(np.append(start, len(conv))), size[start]
    turns = np.repeat(new, np.diff(first))  # those of the distinct strings
    keys, first = keys[turns], np.append(0, np.cumsum(size))
    s = encode(keys, size_bytes[turns], first, shared[start], copies, np.minimum.reduceat(conv, start))

    n, edges = len(s.depth), {0, len(start) - 1}
    rightmost = np.zeros(s.depth.max() + 1, np.int64)
    rightmost[s.depth] = np.arange(n)  # the last of each depth stays
    rightmost, leftmost = rightmost[: size[-1] + 1], np.arange(size[0] + 1)
    side, last, node = np.zeros(n, np.int32), np.zeros(n, bool), np.full(n, None, object)
    side[rightmost], side[leftmost], last[rightmost] = _LAST, _FIRST, True
    for path, string in ((leftmost, 0), (rightmost, len(start) - 1)):
        node[path] = _path_hashes(keys[first[string] : first[string + 1]])
    parent_side = np.append(-1, side[s.parent[1:]]).astype(np.int32)
    # Lists of the first and the last string may go on in other shards; all others are hashed here.
    ends = np.full(n, _NO_ENDS, object)
    for k in range(len(start)):
        ids = conv[start[k] : start[k] + copies[k]]
        ends[s.end[k]] = None if k in edges else hashlib.sha256(_id_list(ids)).hexdigest()
    yield record(
        shard=np.full(n, shard, np.int32), side=side, last=last, depth=s.depth, node=pa.array(node, pa.binary()), conv_id=s.smallest,
        n_convs=s.members, texts=s.texts, weighted=s.weighted, before=s.before, own=s.own, n_leaves=s.leaves, n_children=s.children,
        parent_conv=pa.array(s.smallest[s.parent], mask=parent_side != _INTERIOR), parent_side=parent_side,
        ends=pa.array(ends, pa.string()), piece=pa.nulls(n, pa.int32()), ids=pa.nulls(n, pa.binary()),
    )
    for k in sorted(edges):
        ids = conv[start[k] : start[k] + copies[k]]
        pieces = [_id_list(ids[i : i + PIECE_IDS]) for i in range(0, len(ids), PIECE_IDS)]
        m = len(pieces)
        blank = {c: pa.nulls(m, pa.int64()) for c in ("conv_id", "n_convs", "texts", "weighted", "before", "own", "n_leaves", "n_children", "parent_conv")}
        yield record(
            shard=np.full(m, shard, np.int32), side=pa.nulls(m, pa.int32()), last=pa.nulls(m, pa.bool_()), depth=np.full(m, size[k]),
            node=pa.array([node[s.end[k]]] * m, pa.binary()), **blank, parent_side=pa.nulls(m, pa.int32()),
            ends=pa.nulls(m, pa.string()), piece=np.arange(m, dtype=np.int32), ids=pa.array(pieces, pa.binary()),
        )


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list from its pieces in order; holds one piece at a time."""
    at, h = None, None

    def done() -> pa.RecordBatch:
        return record(depth=pa.array([at[0]], pa.int64()), node=pa.array([at[1]], pa.binary()), ends=pa.array([h.hexdigest()]))

    for batch in batches:
        for key, ids in zip(zip(batch.column("depth").to_pylist(), batch.column("node").to_pylist()), batch.column("ids")):
            if key == at:
                h.update(b",")
            else:
                if h:
                    yield done()
                at, h = key, hashlib.sha256()
            h.update(ids.as_py())
    if h:
        yield done()


def _merged_spines(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the spines over all shards, and the smallest member of the node at each place (shard, side, depth)."""
    same = Window.partitionBy("depth", "node")
    spine = stage(
        rows.where("side > 0").drop("piece", "ids")
        .withColumns({"first_shard": F.min("shard").over(same), "last_shard": F.max("shard").over(same)}),
        "spines",
    )
    # How deep a shard's first string follows the path of earlier shards, the bytes on that path, and whether its last node goes on later.
    repeats = (F.col("side") == _FIRST) & (F.col("first_shard") < F.col("shard"))
    shards = spine.groupBy("shard").agg(
        F.max(F.when(repeats, F.struct("depth", (F.col("before") + F.col("own")).alias("bytes")))).alias("again"),
        F.max(F.when(F.col("last"), F.struct("depth", (F.col("last_shard") > F.col("shard")).alias("later")))).alias("tip"),
    )
    repeated = (F.col("side") == _FIRST) & (F.col("depth") <= F.col("again.depth"))
    fixed = spine.join(shards, "shard").withColumns({
        "texts": F.col("texts") - F.when(repeated, F.col("again.bytes") - F.col("before")).otherwise(0),
        "n_children": F.col("n_children") - F.when(repeated & (F.col("depth") < F.col("again.depth")), 1).otherwise(0),
        # A last node that another shard holds too is counted there, if it is a leaf.
        "n_leaves": F.col("n_leaves") - F.when(F.col("last") & F.col("tip.later"), 1).otherwise(0),
    })
    total = [F.sum(c).alias(c) for c in ("n_convs", "texts", "weighted", "n_leaves", "n_children")]
    merged = fixed.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), *total, F.min("before").alias("before"),
        F.min(F.struct("shard", "side", "parent_side")).alias("place"), F.max(F.when(F.col("ends") != _NO_ENDS, F.col("ends"))).alias("whole"),
    )
    lists = rows.where("piece IS NOT NULL").select("depth", "node", "shard", "piece", "ids").repartition("depth", "node")
    hashed = lists.sortWithinPartitions("depth", "node", "shard", "piece").mapInArrow(_hash_lists, "depth long, node binary, ends string")
    nodes = stage(
        merged.join(hashed, ["depth", "node"], "left").withColumn("ends", F.coalesce("ends", "whole", F.lit(_NO_ENDS))), "spine_nodes"
    )
    located = spine.select("shard", "side", "depth", "node").join(nodes.select("depth", "node", "conv_id"), ["depth", "node"])
    return nodes, located.select("shard", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``convs`` (``conv, turns``, as from ``conversations``).

    ``conv_id`` (smallest member) and ``depth`` name a node's prefix. Columns:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    spark = convs.sparkSession
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    strings = stage(convs.select("conv", key.alias("key"), F.col("turns.bytes").alias("bytes")), "strings")
    total = strings.agg(F.sum(F.size("bytes") + 1)).first()[0] or 0
    idle = min(2 * spark.sparkContext.defaultParallelism, -(-total // LEAST_TURNS))
    shards = max(1, -(-total // SHARD_TURNS), idle)
    ranged = strings.repartitionByRange(shards, "key", "conv").sortWithinPartitions("key", "conv")
    rows = stage(ranged.mapInArrow(_shard_rows, _SHARD), "trie_shards")
    spines, above = _merged_spines(rows)
    inner = rows.where(F.col("side") == _INTERIOR).drop("node", "piece", "ids").join(above, ["shard", "parent_side", "depth"], "left")
    outer = spines.select("*", "place.shard", "place.parent_side").join(above, ["shard", "parent_side", "depth"], "left")

    def shown(nodes: DataFrame, parent: Column) -> DataFrame:
        saved = F.col("weighted") - F.col("n_convs") * F.col("before") - F.col("texts")
        return nodes.select(
            "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
            F.col("ends").alias("ends_sha256"),
        )

    return shown(inner, F.coalesce("parent_conv", "above")).unionByName(shown(outer, F.col("above")))
