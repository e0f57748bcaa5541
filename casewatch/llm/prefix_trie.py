"""Conversation prefix trie by adaptive radix trees.

A distinct (role, text) is a turn id of 8 big-endian bytes, a conversation the bytes of its ids. Keys
are cut into chunks of `CHUNK` turns; what comes before a chunk is named by a 128-bit hash, the XOR of
the hashes of the earlier (chunk number, chunk) pairs, so a long conversation is many small rows that
need not meet. Equal chunks under one name are one row with a count; sorted into ranges, they are
inserted into adaptive radix trees, whose turn-aligned byte depths are the trie's nodes. What ranges
find of one node is added up by its name.

Sums over a subtree: a node belongs to its smallest member, so each conversation owns the end of its
own path from some depth on; a subtree's sum is what its members own, less what the smallest member
owns above it. The first part is again a sum over members, found by a second pass over the trees.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.llm.common import keyed, ranked, written

#: Turns of a chunk, bytes of a turn id.
CHUNK = 16
WIDTH = 8
#: Keys of one radix tree; a task builds one after the other.
TREE_KEYS = 50_000
#: Ids that are joined into one string before hashing.
ENDS = 4096
#: Rebuilt conversations share turns within ids of the same hundred, and fewer than this many.
FAMILY = 100
SHARED = 6


class _Node:
    """A radix tree node: compressed path, aggregates of all keys below, and children in one of four
    layouts: sorted byte and child lists of up to 4 and up to 16, a byte index into up to 48 children,
    and 256 direct slots."""

    __slots__ = ("path", "sums", "low", "keys", "children", "layout", "size")

    def __init__(self, path: bytes, sums: list[int], low: int):
        self.path, self.sums, self.low = path, sums, low
        self.layout, self.size = 4, 0
        self.keys: list[int] | bytearray | None = []
        self.children: list = []

    def child(self, byte: int) -> _Node | None:
        if self.layout == 256:
            return self.children[byte]
        if self.layout == 48:
            at = self.keys[byte]
            return self.children[at - 1] if at else None
        at = bisect_left(self.keys, byte)
        return self.children[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, node: _Node) -> None:
        """Add or replace the child of a byte, growing the layout when it is full."""
        if self.child(byte) is None and self.size == self.layout:
            self._grow()
        if self.layout == 256:
            self.size += self.children[byte] is None
            self.children[byte] = node
        elif self.layout == 48:
            if not self.keys[byte]:
                self.children.append(node)
                self.size += 1
                self.keys[byte] = self.size
            else:
                self.children[self.keys[byte] - 1] = node
        else:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.children[at] = node
            else:
                self.keys.insert(at, byte)
                self.children.insert(at, node)
                self.size += 1

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray(256)
            for i, byte in enumerate(self.keys, 1):
                index[byte] = i
            self.keys, self.layout = index, 48
        else:
            slots = [self.children[at - 1] if at else None for at in self.keys]
            self.keys, self.children, self.layout = None, slots, 256

    def below(self) -> Iterator[_Node]:
        return (c for c in self.children if c is not None)

    def add(self, sums: list[int], low: int) -> None:
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
        self.low = min(self.low, low)


class RadixTree:
    """Keys of whole turns with sums and a least value that every prefix adds up."""

    def __init__(self, n_sums: int):
        self.n_sums = n_sums
        self.top: _Node | None = None

    def insert(self, key: bytes, sums: list[int], low: int) -> None:
        if self.top is None:
            self.top = _Node(b"", [0] * self.n_sums, low)
        node, at = self.top, 0
        node.add(sums, low)
        while at < len(key):
            below = node.child(key[at])
            if below is None:
                node.put(key[at], _Node(key[at:], list(sums), low))
                return
            path = below.path
            same = next((i for i in range(min(len(path), len(key) - at)) if path[i] != key[at + i]), min(len(path), len(key) - at))
            if same < len(path):  # split the compressed path
                upper = _Node(path[:same], list(below.sums), below.low)
                below.path = path[same:]
                upper.put(below.path[0], below)
                node.put(key[at], upper)
                below = upper
            below.add(sums, low)
            node, at = below, at + same

    def turns(self) -> Iterator[tuple[bytes, list[int], int]]:
        """(prefix, sums, least) at each turn-aligned depth below the top."""
        todo = [(c, b"") for c in self.top.below()] if self.top else []
        while todo:
            node, above = todo.pop()
            key = above + node.path
            for end in range((len(above) // WIDTH + 1) * WIDTH, len(key) + 1, WIDTH):
                yield key[:end], node.sums, node.low
            todo += [(c, key) for c in node.below()]


def _name(chunk_no: int, key: bytes) -> tuple[int, int]:
    """The 128-bit hash of a chunk, or of its beginning, at its place, as two signed longs; XOR adds it to what came before."""
    h = hashlib.blake2b(chunk_no.to_bytes(8, "big") + key, digest_size=16).digest()
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _longs(rows: list[tuple], names: list[str], kinds: dict[str, pa.DataType] | None = None) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, (kinds or {}).get(n, pa.int64())) for c, n in zip(cols, names, strict=True)], names=names)


def _chunk_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, chunk, key (bytes) and the key's own hash (kx, ky), from each chunk's turn ids in order."""
    for b in batches:
        rows = []
        for conv, chunk, ids in zip(b.column("conv").to_pylist(), b.column("chunk").to_pylist(), b.column("ids").to_pylist(), strict=True):
            key = np.array(ids, ">u8").tobytes()
            rows.append((conv, chunk, key, *_name(chunk, key)))
        yield _longs(rows, ["conv", "chunk", "key", "kx", "ky"], {"key": pa.binary()})


def _trees(n_sums: int):
    """Rows (chunk, sx, sy: the name of what comes before, key, low, s0, s1, ...) come sorted, so a tree's keys
    are neighbours; a node that several trees or tasks see is given by each of them."""
    sums = [f"s{i}" for i in range(n_sums)]
    names = ["nx", "ny", "px", "py", "depth", "id", "low", *sums]

    def nodes(tree: RadixTree, start: tuple[int, int, int]) -> pa.RecordBatch:
        chunk, sx, sy = start
        rows, name_of = [], {b"": (sx, sy)}

        def name(prefix: bytes) -> tuple[int, int]:
            if prefix not in name_of:
                x, y = _name(chunk, prefix)
                name_of[prefix] = (sx ^ x, sy ^ y)
            return name_of[prefix]
        for prefix, s, low in tree.turns():
            rows.append((*name(prefix), *name(prefix[:-WIDTH]), chunk * CHUNK + len(prefix) // WIDTH, int.from_bytes(prefix[-WIDTH:], "big"), low, *s))
        return _longs(rows, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, tree, held = None, RadixTree(n_sums), 0
        for b in batches:
            for chunk, sx, sy, key, low, *s in zip(*(b.column(c).to_pylist() for c in ("chunk", "sx", "sy", "key", "low", *sums)), strict=True):
                if (chunk, sx, sy) != start or held >= TREE_KEYS:
                    if held:
                        yield nodes(tree, start)
                    start, tree, held = (chunk, sx, sy), RadixTree(n_sums), 0
                tree.insert(key, s, low)
                held += 1
        if held:
            yield nodes(tree, start)
    return run, ", ".join(f"{c} long" for c in names)


def trie_sums(chunks: DataFrame, low: str, sums: list[Column]) -> DataFrame:
    """nx, ny, px, py, depth, id, low, s0, ...: every node below the root, with sums over the conversations that
    begin with it. `chunks` has conv, chunk, key, sx, sy."""
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"s{i}" for i in range(len(sums))]
    equal = chunks.groupBy("chunk", "sx", "sy", "key").agg(F.min(low).alias("low"), *[F.sum(s).alias(n) for s, n in zip(sums, names, strict=True)])
    run, schema = _trees(len(sums))
    order = ["chunk", "sx", "sy", "key"]
    found = equal.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema)
    return found.groupBy("nx", "ny", "px", "py", "depth", "id").agg(F.min("low").alias("low"), *[F.sum(n).alias(n) for n in names])


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes over from the first one of its hundred."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(SHARED)).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) from `turns` (conv, pos from 1, id): every conversation begins with the first h turns of
    that of its hundred (all if it has fewer, none if there is none), then go its own after its first h."""
    base = F.col("conv") - F.col("conv") % FAMILY
    firsts = (turns.filter((F.col("conv") % FAMILY == 0) & (F.col("pos") < SHARED)).groupBy(F.col("conv").alias("base"))
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("first")))  # at most SHARED - 1
    convs = turns.select("conv").distinct().withColumn("base", base).join(firsts, "base", "left")
    convs = written(convs.select("conv", shared_turns(F.col("conv")).alias("h"), F.coalesce("first", F.array().cast("array<long>")).alias("first"))
                    .withColumn("first", F.slice("first", F.lit(1), F.col("h"))), "conversations")
    own = turns.join(convs, "conv").filter("pos > h").select("conv", (F.col("pos") - F.col("h") + F.size("first")).alias("pos"), "id")
    return convs, own.union(convs.select("conv", F.posexplode("first").alias("pos", "id")).select("conv", (F.col("pos") + 1).cast("long").alias("pos"), "id"))


def _turn_rows(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): conv, pos, id of every turn; id, length (code points) of every distinct turn."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = written(keyed(conversations, F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                         digest.alias("digest"), F.length(text).cast("long").alias("length")).filter("conv IS NOT NULL"), "turns")
    ids = ranked(rows.groupBy("digest").agg(F.first("length").alias("length")), ["digest"], "turn-ids").withColumnRenamed("rank", "id")
    ids = written(ids, "turn-ids")
    # A conversation's turns get their places from the rank among all rows, so a long one isn't sorted in one task.
    order = ranked(rows.withColumn("first", F.col("turn").isNotNull()), ["conv", "first", "turn", "role", "digest", "kf", "kr"], "ordered-turns")
    begin = order.groupBy("conv").agg(F.min("rank").alias("begin"))
    turns = order.join(begin, "conv").join(ids.select("digest", "id"), "digest")
    return written(turns.select("conv", (F.col("rank") - F.col("begin") + 1).alias("pos"), "id"), "numbered-turns"), ids.select("id", "length")


def _chunks(turns: DataFrame) -> DataFrame:
    """conv, chunk, key, kx, ky, sx, sy of every rebuilt conversation's chunks."""
    ids = F.transform(F.sort_array(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids")
    own = written(turns.withColumn("chunk", F.expr(f"(pos - 1) DIV {CHUNK}")).groupBy("conv", "chunk").agg(ids)  # at most CHUNK turns a group
                  .mapInArrow(_chunk_names, "conv long, chunk long, key binary, kx long, ky long"), "chunks")
    # What comes before a chunk: first per block of ENDS chunks, so that a long conversation is short here.
    block = F.expr(f"chunk DIV {ENDS}")
    blocks = own.groupBy("conv", block.alias("block")).agg(F.bit_xor("kx").alias("bx"), F.bit_xor("ky").alias("by"))
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", *[F.coalesce(F.bit_xor(c).over(ahead), F.lit(0)).alias(c) for c in ("bx", "by")])
    inside = Window.partitionBy("conv", "block").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    out = own.withColumn("block", block).join(blocks, ["conv", "block"])
    for s, k, b in (("sx", "kx", "bx"), ("sy", "ky", "by")):
        out = out.withColumn(s, F.coalesce(F.bit_xor(k).over(inside), F.lit(0)).bitwiseXOR(F.col(b)))
    return written(out.select("conv", "chunk", "key", "kx", "ky", "sx", "sy"), "named-chunks")


def _sha_of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (nx, ny, part) come in order; one hash a node, carried from part to part."""
    node, state, first = None, None, True
    for b in batches:
        rows = []
        for nx, ny, part in zip(b.column("nx").to_pylist(), b.column("ny").to_pylist(), b.column("part").to_pylist(), strict=True):
            if (nx, ny) != node:
                if state is not None:
                    rows.append((*node, state.hexdigest()))
                node, state, first = (nx, ny), hashlib.sha256(), True
            state.update(part.encode() if first else b"," + part.encode())
            first = False
        yield _longs(rows, ["nx", "ny", "ends_sha256"], {"ends_sha256": pa.string()})
    if state is not None:
        yield _longs([(*node, state.hexdigest())], ["nx", "ny", "ends_sha256"], {"ends_sha256": pa.string()})


def _ends(convs: DataFrame, chunks: DataFrame) -> DataFrame:
    """nx, ny, ends_sha256 of nodes that whole conversations end at.

    A node's ids are joined ENDS at a time before they meet, so where a third of all conversations are
    equal, one task hashes their string (SHA-256 has no other order) but holds none of it.
    """
    last = chunks.groupBy("conv").agg(F.max(F.struct("chunk", F.col("sx").bitwiseXOR(F.col("kx")).alias("nx"), F.col("sy").bitwiseXOR(F.col("ky")).alias("ny"))).alias("l"))
    at = convs.select("conv").join(last, "conv", "left").select("conv", *[F.coalesce(f"l.{c}", F.lit(0)).alias(c) for c in ("nx", "ny")])
    order = ranked(at, ["nx", "ny", "conv"], "ends")
    part = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))).alias("part")
    parts = written(order.groupBy("nx", "ny", F.expr(f"rank DIV {ENDS}").alias("block")).agg(part), "end-parts")
    return parts.repartition("nx", "ny").sortWithinPartitions("nx", "ny", "block").select("nx", "ny", "part").mapInArrow(
        _sha_of_ends, "nx long, ny long, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations: conv_id (the smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Reads conv_id, turn, role and text; other columns are ignored. Turns go by `turn` (null first), ties
    by role, then by the digest of role and text, so repeated rows are turns of their own. A null role or
    text counts as empty. A row without conv_id belongs to no conversation and is left out. The root
    (depth 0, no text) stands for all conversations, the turnless among them; an empty table gives an
    empty result.
    """
    turns, ids = _turn_rows(conversations)
    convs, own = rebuilt(turns)
    chunks = _chunks(own)
    node = ["nx", "ny"]
    counted = trie_sums(chunks, "conv", [F.lit(1)])
    root = convs.agg(F.count("*").alias("n"), F.min("conv").alias("low")).filter("n > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in node], *[F.lit(None).cast("long").alias(c) for c in ("px", "py")],
        F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("id"), "low", F.col("n").alias("s0"))
    counted = counted.unionByName(root)
    children = counted.filter("depth > 0").groupBy(F.col("px").alias("nx"), F.col("py").alias("ny")).agg(F.count("*").alias("n_children"))
    nodes = written(counted.join(ids, "id", "left").join(children, node, "left").select(
        *node, "px", "py", "depth", F.col("low").alias("conv"), F.col("s0").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("s0") - 1) * F.coalesce("length", F.lit(0))).alias("saved")), "nodes")

    # What each conversation owns, and what it owns above each of its nodes.
    chain = ranked(nodes.select("conv", "depth", "saved"), ["conv", "depth"], "chains", {"saved": "saved"})
    owned = written(chain.groupBy("conv").agg(F.sum("saved").alias("saved"), F.min("saved_before").alias("begin")), "owned")
    leaves = nodes.filter("n_children = 0").select("conv", F.lit(1).alias("leaf"))  # a conversation owns one leaf at most: its end
    weights = written(owned.join(leaves, "conv", "left").select("conv", "saved", F.coalesce("leaf", F.lit(0)).alias("leaf")), "weights")
    below = trie_sums(chunks.join(weights, "conv", "left"), "conv", [F.coalesce("saved", F.lit(0)), F.coalesce("leaf", F.lit(0))])
    whole = weights.agg(F.coalesce(F.sum("saved"), F.lit(0)).alias("s0"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("s1"))
    below = written(below.select(*node, "s0", "s1").union(whole.select(*[F.lit(0).cast("long").alias(c) for c in node], "s0", "s1")), "subtrees")
    above = chain.join(owned.select("conv", "begin"), "conv").select("conv", "depth", (F.col("saved_before") - F.col("begin")).alias("above"))

    parents = nodes.select(F.col("nx").alias("px"), F.col("ny").alias("py"), F.col("conv").alias("parent_conv_id"))
    return (nodes.join(below, node).join(above, ["conv", "depth"]).join(_ends(convs, chunks), node, "left").join(parents, ["px", "py"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("s1").alias("n_leaves"),
                    (F.col("s0") - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
