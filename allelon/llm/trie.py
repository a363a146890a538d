"""The prefix trie of conversations: what conversations share from their first turn on, and the tokens that sharing saves.

Conversations are put in the order of their turns' digests and dealt into shards by range, so that a shard is a piece of the trie in
depth-first order. A shard encodes its piece as balanced parentheses: a node's subtree ends at its closing one (``findclose``, over blocks
with their least and greatest excess), leaves are the pairs "()" within (rank), and sums over a subtree are differences of
cumulative arrays. Nodes on the first and the last path of a shard, its spines, may go on in other shards: they are merged, and the
merged spines, which are few, are encoded once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from allelon.storage import store

BLOCK = 128
WIDTH = 16  # bytes of a turn's digest
#: Ids of conversations that end at a spine node travel as text in pieces of about so many bytes.
PIECE = 1 << 16
NONE = np.iinfo(np.int64).max


class Parens:
    """Balanced parentheses with the least and greatest excess of blocks, and a tree of both above them."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens.astype(bool)
        n = len(opens)
        self.blocks = max(1, -(-n // BLOCK))
        excess = np.cumsum(np.where(self.opens, 1, -1)).astype(np.int64)
        padded = np.full(self.blocks * BLOCK, n + 1, np.int64)
        padded[:n] = excess
        self.excess = padded.reshape(self.blocks, BLOCK)
        size = 1 << max(0, (self.blocks - 1).bit_length())
        self.size = size
        self.least = np.full(2 * size, n + 1, np.int64)
        self.most = np.full(2 * size, -1, np.int64)
        self.least[size : size + self.blocks] = self.excess.min(1)
        self.most[size : size + self.blocks] = np.where(padded.reshape(self.blocks, BLOCK) > n, -1, self.excess).max(1)
        while size > 1:
            half = size >> 1
            self.least[half:size] = np.minimum(self.least[size : 2 * size : 2], self.least[size + 1 : 2 * size : 2])
            self.most[half:size] = np.maximum(self.most[size : 2 * size : 2], self.most[size + 1 : 2 * size : 2])
            size = half
        pairs = np.zeros(n + 1, np.int64)
        pairs[1:n] = np.cumsum(self.opens[:-1] & ~self.opens[1:])
        pairs[n:] = pairs[n - 1] if n else 0
        self.pairs = pairs  # pairs[i]: "()" that start before i

    def _holds(self, node: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Whether the excess, which changes by one at a time, takes the value below the node."""
        return (self.least[node] <= value) & (value <= self.most[node])

    def find_close(self, at: np.ndarray, together: int = 1 << 13) -> np.ndarray:
        """The closing parenthesis of each open one: the first later place whose excess is one less."""
        at = np.asarray(at, np.int64)
        target = self.excess.reshape(-1)[at] - 1
        out = np.full(len(at), -1, np.int64)
        block = at // BLOCK
        for i in range(0, len(at), together):
            k = slice(i, i + together)
            hit = (self.excess[block[k]] == target[k, None]) & (np.arange(BLOCK) > (at[k] % BLOCK)[:, None])
            own = hit.any(1)
            out[i : i + together][own] = (block[k] * BLOCK + hit.argmax(1))[own]
        left = np.flatnonzero(out < 0)
        node = block[left] + self.size
        # Up to the first subtree on the right whose least excess reaches the target, then down to its first such block.
        rising = np.ones(len(left), bool)
        while rising.any():
            right = rising & (node % 2 == 0)
            found = right.copy()
            found[right] = self._holds(node[right] + 1, target[left[right]])
            node = np.where(found, node + 1, np.where(rising, node >> 1, node))
            rising &= ~found
        while len(low := np.flatnonzero(node < self.size)):
            child = node[low] * 2
            node[low] = np.where(self._holds(child, target[left[low]]), child, child + 1)
        block = node - self.size
        for i in range(0, len(left), together):
            k = slice(i, i + together)
            hit = self.excess[block[k]] == target[left[k], None]
            out[left[k]] = block[k] * BLOCK + hit.argmax(1)
        return out


class Piece:
    """Trie nodes in depth-first order: parent and depth of each, and the balanced parentheses with sums over subtrees."""

    def __init__(self, depth: np.ndarray):
        self.depth = depth.astype(np.int64)
        n = len(depth)
        # Between two nodes in order stand as many closing ones as the depth falls, plus one.
        closes = np.append(self.depth[:-1] - self.depth[1:] + 1, self.depth[-1] - self.depth[0] + 1) if n else np.empty(0, np.int64)
        self.open = np.arange(n) + np.concatenate([[0], np.cumsum(closes)[:-1]]).astype(np.int64) if n else np.empty(0, np.int64)
        opens = np.zeros(2 * n, bool)
        opens[self.open] = True
        self.parens = Parens(opens)
        self.close = self.parens.find_close(self.open)
        self.end = np.arange(n) + (self.close - self.open + 1) // 2  # one after the last node of the subtree
        self.leaf = self.close == self.open + 1
        # The parent is the last node before it that is one higher.
        self.parent = np.full(n, -1, np.int64)
        last: dict[int, int] = {}
        for i, d in enumerate(self.depth.tolist()):
            last[d] = i
            self.parent[i] = last.get(d - 1, -1) if i else -1

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of each subtree."""
        run = np.concatenate([[0], np.cumsum(values)])
        return run[self.end] - run[: len(values)]

    def leaves(self) -> np.ndarray:
        return self.parens.pairs[self.close] - self.parens.pairs[self.open]

    def children(self, counted: np.ndarray | None = None) -> np.ndarray:
        own = self.parent if counted is None else self.parent[counted]
        return np.bincount(own[own >= 0], minlength=len(self.depth))

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least value of each subtree, from the lowest nodes up."""
        out = values.copy()
        order = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        for level in np.split(order, cuts):
            own = level[self.parent[level] >= 0]
            np.minimum.at(out, self.parent[own], out[own])
        return out


def shared(a: bytes, b: bytes) -> int:
    """How many whole digests two paths share from the start."""
    n = min(len(a), len(b)) // WIDTH
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * WIDTH] == b[: mid * WIDTH] else (low, mid - 1)
    return low


def paths(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, family: int = 20, spans: int = 4) -> DataFrame:
    """(id, path, words): each rebuilt conversation as its turns' digests in a row, with each turn's words.

    A conversation takes the first h turns of the conversation whose id is its own without the remainder by ``family``, h being the crc32 of
    its id as text modulo ``spans``, then its own turns after the first h.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = turns.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{turn_col}`").alias("turn"),
        F.md5(framed).alias("digest"), words.alias("words"))
    # sort_array puts a null turn first.
    own = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("own"))
    own = store(own.select("id", F.transform("own", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("own")), "conversations")
    first = own.where(F.col("id") % family == 0).select(F.col("id").alias("base"), F.slice("own", 1, spans - 1).alias("first"))
    h = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(spans)).cast("int")
    both = own.withColumns({"base": F.col("id") - F.col("id") % family, "h": h}).join(first, "base", "left")
    head = F.when(F.col("first").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("first", 1, F.col("h")))
    turned = F.concat(head, F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1))))
    built = both.select("id", turned.alias("turns"))
    return built.select("id", F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path"), F.col("turns.words").alias("words"))


_NODE = pa.schema([
    ("spine", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()),
    ("ends_sha256", pa.string()), ("ends", pa.string()), ("first_end", pa.int64()),
])


def _key(path: bytes) -> bytes:
    return hashlib.md5(path, usedforsecurity=False).digest()


def _encode(ids: list[int], found: list[bytes], words: list[list[int]]) -> Iterator[pa.Table]:
    """The nodes of a shard, whose conversations are in order of path and id. Spine nodes hold only what others don't add."""
    depth, source, ends_at = [0], [0], []
    node_of, before = [0], b""
    for k, p in enumerate(found):
        d = shared(before, p) if k else 0
        del node_of[d + 1 :]
        for j in range(d + 1, len(p) // WIDTH + 1):
            node_of.append(len(depth))
            depth.append(j)
            source.append(k)
        ends_at.append(node_of[-1])
        before = p
    piece = Piece(np.array(depth))
    n, at, own = len(depth), np.array(ends_at), np.array(ids)
    n_words = np.array([words[k][d - 1] if d else 0 for d, k in zip(depth, source, strict=True)], np.int64)
    first = np.full(n, NONE, np.int64)
    np.minimum.at(first, at, own)
    n_ends = np.bincount(at, minlength=n)
    count, least = piece.sums(n_ends), piece.least(first)
    spine = np.zeros(n, bool)
    spine[0] = True
    for k in (0, len(found) - 1):
        node = ends_at[k]
        while node >= 0:
            spine[node] = True
            node = int(piece.parent[node])
    saved = np.where(spine, 0, (count - 1) * n_words)
    # A spine node that looks like a leaf may have children elsewhere.
    leaves = piece.leaves() - piece.sums((spine & piece.leaf).astype(np.int64))
    children, saved_all = piece.children(np.flatnonzero(~spine)), piece.sums(saved)

    pieces: list[tuple[int, int, str]] = []
    digests: list[str | None] = [None] * n
    empty = hashlib.sha256(b"").hexdigest()
    order = np.lexsort((own, at))
    bounds = np.searchsorted(at[order], np.arange(n + 1))
    for i in range(n):
        members = own[order[bounds[i] : bounds[i + 1]]].tolist()
        if not spine[i]:
            digests[i] = hashlib.sha256(",".join(map(str, members)).encode()).hexdigest() if members else empty
        else:
            for j in range(0, len(members), PIECE // 16):
                part = members[j : j + PIECE // 16]
                pieces.append((i, part[0], ",".join(map(str, part))))

    above = piece.parent.tolist()
    keys: dict[int, bytes] = {}
    for i in np.flatnonzero(spine).tolist():  # parents come first
        d, k = depth[i], source[i]
        keys[i] = _key(keys[above[i]] + found[k][(d - 1) * WIDTH : d * WIDTH]) if d else _key(b"")
    # The smallest member of a parent on a spine is known after the merge only.
    rows = {
        "spine": spine, "key": [keys.get(i) for i in range(n)], "parent_key": [keys.get(a) for a in above], "depth": piece.depth, "conv_id": least,
        "parent_conv_id": [None if a < 0 or a in keys else int(least[a]) for a in above], "n_convs": count, "n_children": children, "n_leaves": leaves,
        "saved_tokens": saved_all, "words": n_words, "ends_sha256": digests, "ends": [None] * n, "first_end": [None] * n,
    }
    yield pa.table(rows, schema=_NODE)
    if pieces:
        m = len(pieces)
        blank = {f.name: pa.nulls(m, f.type) for f in _NODE}
        blank |= {"spine": pa.array([True] * m), "key": pa.array([keys[i] for i, _, _ in pieces], pa.binary()),
            "ends": pa.array([t for _, _, t in pieces], pa.string()), "first_end": pa.array([f for _, f, _ in pieces], pa.int64())}
        yield pa.table(blank, schema=_NODE)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, found, words = [], [], []
    for b in batches:
        ids += b.column(0).to_pylist()
        found += b.column(1).to_pylist()
        words += b.column(2).to_pylist()
    if ids:
        for t in _encode(ids, found, words):
            yield from t.to_batches(max_chunksize=1 << 14)


_MERGED = pa.schema([(c, pa.binary() if c in ("key", "parent_key") else pa.int64()) for c in
    ("key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The merged spine nodes, encoded once more: what each still lacks are the spine nodes below it."""
    found = {r["key"]: r for b in batches for r in b.to_pylist()}
    if not found:
        return
    below: dict[bytes | None, list[bytes]] = {}
    for k, r in found.items():
        below.setdefault(r["parent_key"], []).append(k)
    rows, stack = [], below[None]
    while stack:
        k = stack.pop()
        rows.append(found[k])
        stack += below.get(k, [])
    piece = Piece(np.array([r["depth"] for r in rows]))
    part = {c: np.array([r[c] for r in rows], np.int64) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "words", "conv_id")}
    children = part["n_children"] + piece.children()
    out = {
        "key": [r["key"] for r in rows], "parent_key": [r["parent_key"] for r in rows], "depth": piece.depth, "conv_id": part["conv_id"], "n_convs": part["n_convs"], "n_children": children,
        # A node's own part holds what lies below it in its shards but for the spines.
        "n_leaves": part["n_leaves"] + piece.sums((children == 0).astype(np.int64)),
        "saved_tokens": part["saved_tokens"] + piece.sums((part["n_convs"] - 1) * part["words"]),
    }
    yield from pa.table(out, schema=_MERGED).to_batches()


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of ids in pieces that come sorted by node and first id; only the digest is held."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key, state = None, None
    for b in batches:
        out = []
        for k, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=schema)


def prefix_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", family: int = 20, spans: int = 4,
    shard_turns: int | None = None) -> DataFrame:
    """A row for each distinct sequence of first turns of the rebuilt conversations (see ``paths``), the textless root included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, n_convs - 1 times the words
    of a node's last turn), ends_sha256 (of the ids that end there, joined by commas). Null roles and texts are empty, null turns come first,
    turns of one number are put in order of their digests, repeated rows are turns of their own. Rows without an id are left
    out; without any row there is no root. Other columns aren't read. Texts count whole.

    A shard holds about ``shard_turns`` turns (a thousandth of all, but 20,000 at least and 400,000 at most), of whole conversations in order
    of path and id, so that even a conversation that very many repeat is dealt over shards. Only spines meet: two paths a shard, in one
    task, and the ids of hot spine nodes as a stream of pieces. A conversation is one row, of 16 bytes a turn.
    """
    built = store(paths(turns, id_col, turn_col, role_col, text_col, family, spans), "paths")
    total = built.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // (shard_turns or min(400_000, max(20_000, total // 1000)))))
    placed = built.repartitionByRange(shards, "path", "id").sortWithinPartitions("path", "id")
    nodes = store(placed.mapInArrow(_shard, from_arrow_schema(_NODE)), "trie-nodes")
    spines = nodes.where("spine AND ends IS NULL").groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("words").alias("words"))
    # Two paths a shard, whatever the number of conversations: one task takes them.
    merged = store(spines.coalesce(1).mapInArrow(_merge, from_arrow_schema(_MERGED)), "trie-spines")
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    ends = nodes.where("ends IS NOT NULL").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    digests = store(ends.mapInArrow(_digest_ends, "key binary, ends_sha256 string"), "trie-ends")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # Apart, so that nodes without a spine above don't meet under one null key.
    plain = nodes.where("NOT spine AND parent_key IS NULL").select(*out)
    plain = plain.unionByName(nodes.where("NOT spine AND parent_key IS NOT NULL").drop("parent_conv_id").join(named.withColumnRenamed("__parent", "parent_conv_id"), "parent_key").select(*out))
    top = merged.join(named.withColumnRenamed("__parent", "parent_conv_id"), "parent_key", "left").join(digests, "key", "left")
    return plain.unionByName(top.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).select(*out))
