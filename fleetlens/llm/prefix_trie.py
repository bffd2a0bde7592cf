"""Prefix trie of conversations: z-fast tries with fat binary search, merged by the hashes of prefixes.

1.  A conversation is the sequence of its turns' digests.  The hash of a prefix chains them, so equal prefixes of whatever
    conversations have equal hashes, and two paths part where their hashes begin to differ.
2.  Each task keeps a z-fast trie of the conversations it meets.  A node is compacted: it ends where a conversation ends or
    where paths part, and stands for all depths of the edge above it.  A hash table finds it by its handle, the prefix whose
    depth is the two-fattest number on its edge.  A conversation's exit node is found by fat binary search, with as many
    looks at the table as its length has bits.
3.  Conversations are inserted in batches: all of a batch are located first, then those with one exit node are put there one
    after the other.  A batch that finds the trie full (a bound on memory) starts a new one; what it held leaves as rows.
4.  At the end edges are expanded: a row per depth, with the members below.  Rows of one prefix from all tasks are merged by
    an aggregate, so a prefix that a third of all conversations share is one row per trie, not a task of its own.
5.  Sums over subtrees need no walk.  The node of a smallest member m at depth d is named by (m, d), and m's own nodes are
    the last ones of its path.  For a node at depth d above those, m adds the bytes of its turns from d to where its own ones
    begin (they are shared); and m adds a leaf to all its nodes if its last one has no children.

Turns are ordered by turn (nulls first), then by the MD5 of role and text; a null role or text is empty.  Repeated rows are
turns of their own.  Rows without a conv_id belong to no conversation and are left out.  An empty table has no nodes.  Other
columns don't matter.  A conversation's digests are one row of some 24 bytes a turn; its texts are not gathered.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.llm.common import checkpointed, ship

#: Bytes of a digest or a prefix hash.
WIDTH = 16
ROOT = bytes(WIDTH)
#: Turns a task's trie holds at most before it is emptied.
TRIE_TURNS = 400_000


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that most powers of two divide."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def prefix_hashes(digests: list[bytes]) -> list[bytes]:
    """The hashes of all prefixes, the empty one first."""
    hashes = [ROOT]
    for digest in digests:
        hashes.append(hashlib.blake2b(hashes[-1] + digest, digest_size=WIDTH).digest())
    return hashes


class Node:
    """A compacted node: the edge (low, high] above it, on the path of one conversation, and who ends at its end."""

    __slots__ = ("low", "high", "path", "sizes", "children", "ends", "least", "members")

    def __init__(self, low: int, high: int, path: list[bytes], sizes: list[int]):
        self.low, self.high, self.path, self.sizes = low, high, path, sizes
        self.children: dict[bytes, Node] = {}
        self.ends, self.least, self.members = 0, None, 0

    @property
    def handle(self) -> bytes:
        return self.path[two_fattest(self.low, self.high)]


class ZFastTrie:
    """Conversations as paths of prefix hashes, each with a weight and a name of which the least one of a subtree is kept."""

    def __init__(self):
        self.root = Node(0, 0, [ROOT], [])
        self.handles: dict[bytes, Node] = {}
        self.turns = 0

    def exit_node(self, path: list[bytes]) -> Node:
        """The node on whose edge or at whose end the path leaves the trie (or ends), by fat binary search."""
        node, low, high = self.root, 0, len(path) - 1
        while low < high:
            at = two_fattest(low, high)
            found = self.handles.get(path[at])
            if found is None:
                high = at - 1
            elif found.high < len(path) and path[found.high] == found.path[found.high]:
                node, low = found, found.high
            else:
                return found  # the path holds the handle, but not the whole edge
        # An edge that the path leaves before its handle is found by the first turn on it.
        return node.children.get(path[low + 1], node) if low + 1 < len(path) else node

    def insert(self, paths: list[tuple[list[bytes], list[int], int]]) -> None:
        """A batch of (prefix hashes, sizes of turns, name)."""
        groups = defaultdict(list)
        for item in paths:
            node = self.exit_node(item[0])
            groups[id(node)].append((node, item))
        for group in groups.values():
            for k, (node, item) in enumerate(group):
                # The first one of a group finds the trie as it was located; the others may find it changed by those before.
                self._put(self.exit_node(item[0]) if k else node, *item)

    def _put(self, node: Node, path: list[bytes], sizes: list[int], name: int) -> None:
        end = len(path) - 1
        self.turns += end
        # The last depth that the edge and the path share; hashes are equal up to it and differ beyond.
        low, high = node.low, min(node.high, end)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if node.path[middle] == path[middle] else (low, middle - 1)
        if low < node.high:
            node = self._split(node, low)
        if low < end:
            leaf = Node(low, end, path, sizes)
            node.children[path[low + 1]] = leaf
            self.handles[leaf.handle] = leaf
            node = leaf
        node.ends += 1
        node.least = name if node.least is None else min(node.least, name)

    def _split(self, node: Node, at: int) -> Node:
        """Cuts the edge above `node` at depth `at`; gives the new node there."""
        del self.handles[node.handle]
        upper = Node(node.low, at, node.path, node.sizes)
        parent = self._parent_of(node)
        parent.children[node.path[node.low + 1]] = upper
        node.low = at
        upper.children[node.path[at + 1]] = node
        self.handles[upper.handle] = upper
        self.handles[node.handle] = node
        return upper

    def _parent_of(self, node: Node) -> Node:
        """The node at whose end the edge of `node` begins: the exit node of that prefix."""
        return self.exit_node(node.path[: node.low + 1])

    def nodes(self) -> list[Node]:
        """All nodes, children before parents, with the members of their subtrees summed up."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        order.reverse()
        for node in order:
            below = list(node.children.values())
            node.members = node.ends + sum(child.members for child in below)
            least = [x for x in (node.least, *(child.least for child in below)) if x is not None]
            node.least = min(least, default=None)
        return order

    def expanded(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int]]:
        """(prefix, parent's prefix, depth, members, least member, bytes of the last turn) for every depth of every edge."""
        for node in self.nodes():
            if node.members == 0:
                continue
            for depth in range(node.low + 1, node.high + 1):
                yield node.path[depth], node.path[depth - 1], depth, node.members, node.least, node.sizes[depth - 1]
            if node is self.root:
                yield ROOT, None, 0, node.members, node.least, 0


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size) per turn of `turns` (conv_id, turn, role, text); places from 1."""
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].alias("turn"),
        F.unhex(F.md5(named.cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "digest"))
    return rows.select("conv_id", place.alias("place"), "digest", "size")


def crossed(rows: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size): the conversations of `rows` with beginnings from another one.

    Conversation c begins with the first h turns of conversation c - c % 5 (none, if there is none) and goes on with its own
    turns after the first h, h being the CRC-32 of its decimal id modulo 9.  A conversation without turns has one row of nulls.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h")
    ids = rows.select("conv_id").distinct().select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    heads = rows.where("place <= 8").withColumnRenamed("conv_id", "base")
    begun = ids.join(heads, "base").where("place <= h").select("conv_id", "place", "digest", "size")
    own = rows.withColumn("h", h).where("place > h").select("conv_id", "place", "digest", "size")
    none = ids.select("conv_id", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("place", "digest", "size")])
    return own.union(begun).union(none)


def walks(rows: DataFrame) -> DataFrame:
    """(conv_id, prefixes, sizes) per conversation of `rows` (conv_id, place, digest, size): hashes of its prefixes, bytes of its turns.

    Rows without a digest are no turns; they only name a conversation.
    """
    ship(rows.sparkSession)
    turn = F.when(F.col("digest").isNotNull(), F.struct("place", "digest", "size"))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                ids, digests, sizes = batch.slice(i, 2000).columns
                prefixes = pa.array([prefix_hashes(d)[1:] for d in digests.to_pylist()], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([ids, prefixes, sizes], ["conv_id", "prefixes", "sizes"])

    parts = gathered.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    return parts.mapInArrow(chain, "conv_id long, prefixes array<binary>, sizes array<long>")


_PARTS = [("prefix", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("members", pa.int64()), ("least", pa.int64()), ("size", pa.int64())]


def partial_nodes(walked: DataFrame, trie_turns: int = TRIE_TURNS) -> DataFrame:
    """(prefix, parent, depth, members, least, size): the nodes of every task's tries over `walked` (conv_id, prefixes, sizes)."""
    ship(walked.sparkSession)

    def rows_of(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        rows = list(trie.expanded())
        for i in range(0, len(rows), 20_000):
            columns = zip(*rows[i : i + 20_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, of) for c, (_, of) in zip(columns, _PARTS)], [name for name, _ in _PARTS])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                ids, prefixes, sizes = (column.to_pylist() for column in batch.slice(i, 1000).columns)
                trie.insert([([ROOT, *path], size, name) for name, path, size in zip(ids, prefixes, sizes)])
                if trie.turns >= trie_turns:
                    yield from rows_of(trie)
                    trie = ZFastTrie()
        yield from rows_of(trie)

    return walked.select("conv_id", "prefixes", "sizes").mapInArrow(
        grow, "prefix binary, parent binary, depth long, members long, least long, size long"
    )


def shared_bytes(sizes: list[int], own: int) -> list[int]:
    """By depth, the bytes of the turns from there to depth own - 1; the root has none."""
    above = np.cumsum(np.array([0, *sizes][:own][::-1], np.int64))[::-1]
    return above.tolist() + [0] * (len(sizes) + 1 - len(above))


def path_shares(owned: DataFrame) -> DataFrame:
    """(prefix, leaves, saved) per depth of every path of `owned` (prefixes, sizes, own, leaf).

    `own` is the depth from which the nodes are the conversation's own ones (null: none are), `leaf` whether its last one
    is a childless node of its own.
    """
    ship(owned.sparkSession)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                prefixes, leaves, saved = [], [], []
                for path, sizes, own, leaf in zip(*(c.to_pylist() for c in batch.slice(i, 2000).columns)):
                    prefixes += [ROOT, *path]
                    leaves += [int(leaf)] * (len(path) + 1)
                    saved += shared_bytes(sizes, len(path) + 1 if own is None else own)
                columns = [pa.array(prefixes, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["prefix", "leaves", "saved"])

    return owned.select("prefixes", "sizes", "own", "leaf").mapInArrow(share, "prefix binary, leaves long, saved long")


def ends_hashes(walked: DataFrame) -> DataFrame:
    """(prefix, ends_sha256): for the conversations that end at one node, the hash of their ids in order, comma-joined.

    Ids are joined to texts per range of ids first, so a node at which a third of all conversations end has a small part of
    their rows; its texts pass through one task as a stream, as the hash is one of a sequence.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest, out = None, None, []
        for batch in batches:
            for prefix, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if prefix == last:
                    digest.update(f",{ids}".encode())
                    continue
                if last is not None:
                    out.append((last, digest.hexdigest()))
                last, digest = prefix, hashlib.sha256(ids.encode())
            yield made(out)
            out = []
        yield made([] if last is None else [(last, digest.hexdigest())])

    def made(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        columns = [pa.array([row[0] for row in rows], pa.binary()), pa.array([row[1] for row in rows], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["prefix", "ends_sha256"])

    ship(walked.sparkSession)
    end = F.coalesce(F.try_element_at("prefixes", F.lit(-1)), F.lit(ROOT)).alias("prefix")
    ends = walked.select("conv_id", end, F.shiftright("conv_id", 12).alias("block"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    parts = ends.groupBy("prefix", "block").agg(ids)
    ordered = parts.repartition("prefix").sortWithinPartitions("prefix", "block").select("prefix", "ids")
    return ordered.mapInArrow(hashed, "prefix binary, ends_sha256 string")


def prefix_nodes(rows: DataFrame, trie_turns: int = TRIE_TURNS) -> DataFrame:
    """The nodes of the trie over the conversations of `rows` (conv_id, place, digest, size).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a node is named by its
    smallest member and its depth.
    """
    walked = checkpointed(walks(rows))
    merged = partial_nodes(walked, trie_turns).groupBy("prefix").agg(
        F.any_value("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.sum("members").alias("n_convs"),
        F.min("least").alias("conv_id"),
    )
    merged = checkpointed(merged)
    children = merged.where("parent is not null").groupBy(F.col("parent").alias("prefix")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = checkpointed(merged.join(children, "prefix", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # Of a conversation's own nodes, the last ones of its path, the last one is where it ends.
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("own"), (F.max_by("n_children", "depth") == 0).alias("leaf")
    )
    owned = walked.join(chains, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
    sums = path_shares(owned).groupBy("prefix").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    names = merged.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(sums, "prefix").join(ends_hashes(walked), "prefix", "left").join(names, "parent", "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
