"""Prefix trie of conversations: which beginnings they share, and what storing shared turns once would save.

A conversation is the path of its turns, each turn the digest of its role and text. Equal paths are merged first and
the rest is sorted, so each task holds a range of the trie in preorder and encodes it in shards as balanced
parentheses, one pair per node. Blocks of the parentheses keep the least and the greatest excess, and a tree over the
blocks lets findclose jump to where a subtree ends. All figures of a subtree are then differences of cumulative arrays
between its parentheses: its members, its leaves (ranks of pairs that hold nothing), and the tokens saved.

Nodes on the first and on the last path of a shard, its spines, can be shared with the shards beside it. Shards write
partial figures for them; one more trie, made of the spines alone, merges them. It has two paths per shard, so it is
small beside the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, col, join_counted, require_free, staged, words

# A shard is written when its paths have so many turns.
SHARD_TURNS = 200_000
# Parentheses per block.
BLOCK = 64
# Members that end at the same node are listed in chunks of this range of ids, so that no task sorts all of them.
CHUNK_IDS = 65_536
# Bytes of a turn's digest.
_DIGEST = 32

_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
_SPINE = "n_convs bigint, conv_id bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string"
_NAMES = [x.split()[0] for x in _NODE.split(", ")]
_SPINE_NAMES = [x.split()[0] for x in _SPINE.split(", ")]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id`` and ``turns``, an array of ``digest`` and ``words`` in the order of ``turn``, null first.

    A null role or text is the empty one. Rows of one conversation with the same turn all count, in the order of their
    digests. Rows without a conversation id are in no conversation and are left out. The texts stay where they are:
    what is shuffled is a digest per turn.
    """
    said, told = (F.coalesce(col(x), F.lit("")) for x in (role, text))
    digest = F.sha2(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, told), 256)
    one = F.struct(
        col(turn).isNotNull().alias("numbered"), col(turn).alias("turn"), digest.alias("digest"),
        F.size(words(told)).alias("words"),
    )
    rows = df.filter(col(conv).isNotNull()).select(col(conv).cast("bigint").alias("conv_id"), one.alias("one"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))


def branched(found: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """Each of ``conversations`` continued from another: the first ``shared`` turns (at most ``most``) of conversation
    ``base`` and then its own turns after as many. There are fewer if ``base`` has fewer, and none if it is not there."""
    found = staged(found)
    rows = found.withColumns({"base": base, "shared": F.least(shared, F.lit(most)).cast("int")})
    counts = rows.groupBy("base").agg(F.count(F.lit(1)).alias("rows_of_base"))
    heads = found.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    # many conversations can continue one
    joined = join_counted(rows, staged(heads.join(counts, "base")), ["base"], "rows_of_base", ["conv_id"], how="left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("shared"))
    own = F.slice("turns", F.col("shared") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def trie(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``found`` (``conv_id``, ``turns``, each conversation once).

    A node is a distinct sequence of first turns, the root the empty one; its members are the conversations that begin
    with it. ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (that of the parent, null for the root),
    ``n_convs`` (members), ``n_children``, ``n_leaves`` (nodes without children in its subtree, itself included),
    ``saved_tokens`` (over its subtree, the words of each node's last turn times its members but one), and
    ``ends_sha256`` of the ascending ids of members that end there, joined by commas. No conversations have no nodes.
    """
    require_free(found, "path", "chunk")
    bounded_batches(found)
    rows = found.select(
        "conv_id",
        F.unhex(F.array_join("turns.digest", "")).alias("path"),
        F.col("turns.words").alias("words"),
        F.floor(F.col("conv_id") / CHUNK_IDS).alias("chunk"),
    )
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    merged = rows.groupBy("path", "chunk").agg(
        F.first("words").alias("words"), F.array_join(ids, ",").alias("ids"), F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
    )
    ordered = merged.repartitionByRange("path").sortWithinPartitions("path", "chunk")
    schema = f"node struct<{_fields(_NODE)}>, shard string, parent int, spine struct<first:binary,last:binary,stats:array<struct<{_fields(_SPINE)}>>>"
    sharded = staged(ordered.mapInArrow(_sharding(shard_turns), schema))
    spines = sharded.filter("spine is not null").select("shard", "spine.*")
    # two paths per shard, so one task can take them all
    schema = f"node struct<{_fields(_NODE)}>, shard string, place int, least bigint"
    shared = staged(spines.repartition(1).sortWithinPartitions("first").mapInArrow(_merging, schema))
    known = sharded.filter("node is not null and parent is null").select("node.*")
    places = shared.filter("shard is not null").select("shard", F.col("place").alias("parent"), "least")
    hung = sharded.filter("node is not null and parent is not null").join(places, ["shard", "parent"])
    hung = hung.select(F.col("node").withField("parent_conv_id", F.col("least")).alias("node")).select("node.*")
    return known.unionByName(hung).unionByName(shared.filter("node is not null").select("node.*"))


def _fields(schema: str) -> str:
    return ",".join(x.replace(" ", ":") for x in schema.split(", "))


class Parentheses:
    """Balanced parentheses with blocks of their least and greatest excess, and a tree over the blocks."""

    def __init__(self, opening: np.ndarray, block: int = BLOCK):
        self.opening, self.block = opening, block
        self.excess = np.cumsum(np.where(opening, 1, -1)).astype(np.int64)
        blocks = max(1, -(-len(opening) // block))
        self.width = 1 << (blocks - 1).bit_length()
        large = np.iinfo(np.int64).max
        padded = np.full(blocks * block, large)
        padded[: len(opening)] = self.excess
        self.least = np.full(2 * self.width, large)
        self.greatest = np.full(2 * self.width, -1)
        self.least[self.width : self.width + blocks] = padded.reshape(blocks, block).min(axis=1)
        padded[len(opening) :] = -1
        self.greatest[self.width : self.width + blocks] = padded.reshape(blocks, block).max(axis=1)
        level = self.width
        while level > 1:
            for tree, of_two in ((self.least, np.minimum), (self.greatest, np.maximum)):
                tree[level // 2 : level] = of_two(tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2])
            level //= 2
        # pairs with nothing in between, up to each place
        empty = np.zeros(len(opening) + 1, np.int64)
        empty[1:-1] = opening[:-1] & ~opening[1:]
        self.empty_pairs = np.cumsum(empty)

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the pairs opened at ``opens`` are closed: the next places with an excess lower by one."""
        wanted, found = self.excess[opens] - 1, np.full(len(opens), -1)
        at, todo = opens + 1, np.arange(len(opens))
        while len(todo):  # to the end of the block
            todo = todo[(at[todo] % self.block != 0)]
            hit = self.excess[at[todo]] == wanted[todo]
            found[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
        todo = np.flatnonzero(found < 0)
        tree, want = self.width + at[todo] // self.block, wanted[todo]
        while len(miss := np.flatnonzero(~self._holds(tree, want))):  # past subtrees that do not reach it
            after = tree[miss] + 1
            tree[miss] = after // (after & -after)
        while len(inner := np.flatnonzero(tree < self.width)):
            left = 2 * tree[inner]
            tree[inner] = np.where(self._holds(left, want[inner]), left, left + 1)
        at[todo] = (tree - self.width) * self.block
        while len(todo):
            hit = self.excess[at[todo]] == wanted[todo]
            found[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
        return found

    def _holds(self, tree: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        return (self.least[tree] <= wanted) & (wanted <= self.greatest[tree])

    def leaves(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        return self.empty_pairs[closes] - self.empty_pairs[opens]


class _Builder:
    """A trie in preorder from sorted paths; ``place`` gives the node of each turn of the last path, the root first."""

    def __init__(self) -> None:
        self.bits = bytearray(b"\x01")
        self.depth, self.parent, self.words = [0], [-1], [0]
        self.place, self.path = [0], b""

    def add(self, path: bytes, turn_words: list[int]) -> None:
        common, new = _common(self.path, path), len(path) // _DIGEST
        self.bits.extend(bytes(len(self.place) - 1 - common))
        del self.place[common + 1 :]
        first = len(self.depth)
        self.bits.extend(b"\x01" * (new - common))
        self.depth.extend(range(common + 1, new + 1))
        self.parent.extend([self.place[-1], *range(first, first + new - common - 1)][: new - common])
        self.words.extend(turn_words[common:])
        self.place.extend(range(first, first + new - common))
        self.path = path

    def closed(self) -> tuple[Parentheses, np.ndarray, np.ndarray]:
        """The parentheses, and for each node the place of its opening one and the end of its subtree in preorder."""
        bits = np.frombuffer(bytes(self.bits) + bytes(len(self.place)), np.uint8).astype(bool)
        tree = Parentheses(bits)
        opens = np.flatnonzero(bits)
        closes = tree.findclose(opens)
        rank = np.cumsum(bits)
        return tree, closes, rank[closes]


def _common(one: bytes, other: bytes) -> int:
    """How many first turns two paths share."""
    length = min(len(one), len(other))
    if one[:length] == other[:length]:
        return length // _DIGEST
    low, high = 0, length // _DIGEST  # shared up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if one[: middle * _DIGEST] == other[: middle * _DIGEST]:
            low = middle
        else:
            high = middle
    return low


def _sums(values: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Of each node the sum over its subtree, from cumulative sums in preorder."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[stops] - total[:-1]


def _records(names: list[str], columns: list) -> pa.StructArray:
    arrays = [pa.array(x, pa.string() if name == "ends_sha256" else pa.int64()) for name, x in zip(names, columns)]
    return pa.StructArray.from_arrays(arrays, names)


def _sharding(shard_turns: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: list[list] = []
        turns = 0
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("path", "words", "ids", "n", "least"))):
                path, of_turns, ids, n, least = row
                if paths and paths[-1][0] == path:  # the next chunk of the same members
                    last = paths[-1]
                    last[2].update(b"," + ids.encode())
                    last[3] += n
                    last[4] = min(last[4], least)
                    continue
                if turns >= shard_turns:
                    yield from _shard(paths)
                    paths, turns = [], 0
                paths.append([path, of_turns, hashlib.sha256(ids.encode()), n, least])
                turns += len(of_turns) + 1
        if paths:
            yield from _shard(paths)

    return shards


def _shard(paths: list[list]) -> Iterator[pa.RecordBatch]:
    """The figures of the nodes that only this shard has, and partial ones of those on its spines."""
    trie, ends = _Builder(), {}
    for path, of_turns, digest, n, least in paths:
        trie.add(path, of_turns)
        ends[trie.place[-1]] = (n, least, digest.hexdigest())
        if len(ends) == 1:
            first = list(trie.place)
    tree, closes, stops = trie.closed()
    nodes, opens = len(trie.depth), np.flatnonzero(tree.opening)
    depth, parent, own_words = (np.array(x, np.int64) for x in (trie.depth, trie.parent, trie.words))
    own, least, digests = np.zeros(nodes, np.int64), [None] * nodes, [_NO_ENDS] * nodes
    for node, (n, smallest, digest) in ends.items():
        own[node], least[node], digests[node] = n, smallest, digest
    for node in range(nodes - 1, 0, -1):  # children come after their parents
        up = trie.parent[node]
        if least[up] is None or least[node] < least[up]:
            least[up] = least[node]
    n_convs = _sums(own, stops)
    shared = _common(paths[0][0], paths[-1][0])
    spine = [*first, *trie.place[shared + 1 :]] if len(paths) > 1 else first
    inner = np.ones(nodes, bool)
    inner[spine] = False
    saved = _sums(np.where(inner, (n_convs - 1) * own_words, 0), stops)
    leaf = np.zeros(len(tree.opening), np.int64)
    # a node on a spine may have its children in another shard: whether it is a leaf is seen there
    leaf[opens] = inner & (closes == opens + 1)
    n_leaves = tree.leaves(opens, closes)
    n_leaves[spine] = _sums(leaf[opens], stops)[spine]
    children = np.bincount(parent[1:][inner[1:]], minlength=nodes)
    name = hashlib.sha256(paths[0][0]).hexdigest()
    at = {node: k for k, node in enumerate(spine)}
    only = np.flatnonzero(inner)
    ups = parent[only]
    hung = [at.get(up) for up in ups.tolist()]
    columns = [
        [least[k] for k in only.tolist()], depth[only],
        [None if h is not None else least[up] for h, up in zip(hung, ups.tolist())],
        n_convs[only], children[only], n_leaves[only], saved[only], [digests[k] for k in only.tolist()],
    ]
    stats = {
        "n_convs": n_convs[spine], "conv_id": [least[k] for k in spine], "n_children": children[spine],
        "n_leaves": n_leaves[spine], "saved_tokens": saved[spine], "words": own_words[spine],
        "ends_sha256": [digests[k] for k in spine],
    }
    records = _records(_SPINE_NAMES, [stats[x] for x in _SPINE_NAMES])
    spines = pa.StructArray.from_arrays(
        [
            pa.array([paths[0][0]], pa.binary()),
            pa.array([paths[-1][0]], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(spine)], pa.int32()), records),
        ],
        ["first", "last", "stats"],
    )
    none = pa.nulls(1, pa.struct([pa.field(x, pa.string() if x == "ends_sha256" else pa.int64()) for x in _NAMES]))
    names = ["node", "shard", "parent", "spine"]
    yield pa.RecordBatch.from_arrays([none, pa.array([name]), pa.nulls(1, pa.int32()), spines], names)
    step = 20_000
    every = _records(_NAMES, columns)
    for start in range(0, len(only), step):
        some = every.slice(start, step)
        rows = [some, pa.array([name] * len(some)), pa.array(hung[start : start + step], pa.int32())]
        yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(some), spines.type)], names)


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on spines with their whole figures, and where each shard's partial ones went."""
    trie, refs = _Builder(), []
    sums: dict[str, list[int]] = {x: [0] for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    least: list[int | None] = [None]
    digests = [_NO_ENDS]

    def put(shard: str, offset: int, places: list[int], stats: list[dict]) -> None:
        for k, (node, part) in enumerate(zip(places, stats)):
            if node == len(least):
                least.append(None)
                digests.append(_NO_ENDS)
                for of in sums.values():
                    of.append(0)
            for x, of in sums.items():
                of[node] += part[x]
            if least[node] is None or part["conv_id"] < least[node]:
                least[node] = part["conv_id"]
            if part["ends_sha256"] != _NO_ENDS:
                digests[node] = part["ends_sha256"]
            refs.append((shard, offset + k, node))

    for batch in batches:
        for row in batch.to_pylist():
            first, last, stats = row["first"], row["last"], row["stats"]
            depth = len(first) // _DIGEST + 1
            trie.add(first, [x["words"] for x in stats[1:depth]])
            put(row["shard"], 0, trie.place, stats[:depth])
            if last != first:
                shared = _common(first, last)
                trie.add(last, [0] * shared + [x["words"] for x in stats[depth:]])
                put(row["shard"], depth, trie.place[shared + 1 :], stats[depth:])
    if not refs:
        return
    _, _, stops = trie.closed()
    nodes = len(trie.depth)
    parent, own_words = np.array(trie.parent, np.int64), np.array(trie.words, np.int64)
    n_convs, children, leaves, saved = (np.array(x, np.int64) for x in sums.values())
    children = children + np.bincount(parent[1:], minlength=nodes)
    leaves = leaves + _sums((children == 0).astype(np.int64), stops)
    saved = saved + _sums((n_convs - 1) * own_words, stops)
    columns = [least, trie.depth, [None if p < 0 else least[p] for p in trie.parent], n_convs, children, leaves, saved, digests]
    records = _records(_NAMES, columns)
    names = ["node", "shard", "place", "least"]
    yield pa.RecordBatch.from_arrays(
        [records, pa.nulls(nodes, pa.string()), pa.nulls(nodes, pa.int32()), pa.nulls(nodes, pa.int64())], names
    )
    shards, places, at = zip(*refs)
    where = [pa.array(shards, pa.string()), pa.array(places, pa.int32()), pa.array([least[k] for k in at], pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.nulls(len(refs), records.type), *where], names)
