"""The trie of conversation prefixes, its nodes counted shard by shard.

A conversation's path is the sequence of its turns; a turn stands in it as ``TURN`` bytes,
the first 128 bits of the SHA-256 of role and text and the number of words of the text.
Two turns are the same if these bytes are (different ones agree with odds of 2 ** -128 a
pair).  Every prefix of a path is a node; the root is the empty prefix.

1. Conversations of equal paths are counted, and their ids digested, in blocks of
   neighbouring ids and then block by block, so a path that very many share costs one row
   a block.  The paths are written.
2. Splitters cut the order of all paths into shards: prefixes, as short as they can be, of
   a few paths drawn by their hash.  Drawing changes the sizes of shards only, never a result.
3. The trie of the splitters' proper prefixes is the skeleton.  Only its nodes can have
   paths in several shards: a subtree whose top is no proper prefix of a splitter lies on one
   side of each.  It is broadcast, at most ``SHARDS`` * ``DEEPEST`` nodes.
4. Each task walks its shards in path order with a stack of open nodes: it finishes all
   nodes off the skeleton, and gives a partial sum for each node on it.
5. Partial sums are added per skeleton node; tops of finished subtrees get their parent's id
   from these.

What a node saves, the sum of (n - 1) * words over its subtree, is kept as sums of n * words
and of words, which can be added over shards.

A task holds the open nodes and the children of open nodes, no more than its shards'
nodes.  A conversation's turns are numbered by a window that spills, but its path is one value of
``TURN`` bytes a turn, and the ids that end at one node pass through one task in blocks, as
its SHA-256 can only be taken in order.

Rows without a conversation id take no part.  Null role and text are empty; turns are
ordered by (turn, role, text), null turns first; repeated rows are turns of their own.  An empty
table has no node.  Very long texts count in full.  Columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn in a path: 16 of its digest, 4 of its number of words.
TURN = 20
#: Ids in a block are those that agree but for their last so many bits.
BLOCK_BITS = 12
#: Most shards; turns of different paths that a shard is meant to hold; paths drawn for each.
SHARDS = 4096
SHARD_TURNS = 1 << 20
DRAWN = 8
#: Turns of a drawn path that are looked at.
DEEPEST = 64
ROWS = 1 << 14
EMPTY = hashlib.sha256(b"").hexdigest()

FINISHED = (
    "node int, up int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, weighted long, words long, ends_sha256 string"
)


def turn_key(role: Column, text: Column) -> Column:
    """The hexadecimal digits of a turn's bytes."""
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    n_words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 2 * (TURN - 16), "0")
    return F.concat(F.substring(F.sha2(F.encode(said, "UTF-8"), 256), 1, 32), n_words)


def turn_keys(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, keys): the keys of each conversation's turns in order."""
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.withColumn("key", turn_key(F.col("role"), F.col("text"))).select(
        "conv", F.struct(F.row_number().over(order).alias("at"), "key").alias("said")
    )
    return numbered.groupBy("conv").agg(F.sort_array(F.collect_list("said")).alias("said")).select(
        "conv", F.col("said.key").alias("keys")
    )


def path_of(keys: Column) -> Column:
    return F.unhex(F.array_join(keys, ""))


def ended(paths: DataFrame) -> DataFrame:
    """Each different path once: ``path``, conversations ``n``, least id ``least``, digest of ids ``ends``."""
    ids = F.sort_array(F.collect_list("conv"))
    blocks = paths.groupBy("path", F.shiftright("conv", BLOCK_BITS).alias("block")).agg(ids.alias("ids")).select(
        "path",
        "block",
        F.size("ids").cast("long").alias("n"),
        F.get("ids", F.lit(0)).alias("least"),
        F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("listed"),
    )
    dealt = blocks.repartition("path").sortWithinPartitions("path", "block")
    return dealt.mapInArrow(_digested, "path binary, n long, least long, ends string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the blocks of each path, which come one after another."""
    path, n, least, digest = None, 0, 0, None
    done: list[list] = [[], [], [], []]

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(done, (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["path", "n", "least", "ends"],
        )
        for column in done:
            column.clear()
        return batch

    def finish() -> None:
        if digest is not None:
            for column, value in zip(done, (path, n, least, digest.hexdigest()), strict=True):
                column.append(value)

    for batch in batches:
        for p, more, first, listed in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
            if digest is None or p != path:
                finish()
                path, n, least, digest = p, 0, first, hashlib.sha256()
            elif n:
                digest.update(b",")
            digest.update(listed.encode())
            n += more
        if len(done[0]) >= ROWS:
            yield flush()
    finish()
    if done[0]:
        yield flush()


# ---------------------------------------------------------------- skeleton


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike, by halving."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        mid = (low + high + 1) // 2
        if a[: mid * TURN] == b[: mid * TURN]:
            low = mid
        else:
            high = mid - 1
    return low


def splitters(drawn: list[bytes], shards: int) -> list[bytes]:
    """At most ``shards`` - 1 paths in order that part the drawn ones about evenly."""
    ordered = sorted(set(drawn))
    found = []
    for k in range(1, shards):
        at = k * len(ordered) // shards
        if at:
            before, path = ordered[at - 1], ordered[at]
            found.append(path[: (shared_turns(before, path) + 1) * TURN])
    return sorted(set(found))


class Skeleton:
    """The trie of all proper prefixes of the splitters; node 0 is the root."""

    def __init__(self, splits: list[bytes]):
        self.splits = splits
        self.child: dict[tuple[int, bytes], int] = {}
        self.up, self.depth, self.words, self.children = [-1], [0], [0], [0]
        for path in splits:
            at = 0
            for k in range(0, len(path) - TURN, TURN):
                turn = path[k : k + TURN]
                if (at, turn) not in self.child:
                    self.child[at, turn] = len(self.up)
                    self.children[at] += 1
                    self.up.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.words.append(words_in(turn))
                    self.children.append(0)
                at = self.child[at, turn]

    def rows(self) -> list[tuple[int, int, int, int, int]]:
        """(node, up, depth, children on the skeleton, words of the subtree's skeleton nodes)."""
        below = list(self.words)
        for k in range(len(below) - 1, 0, -1):  # children come after their parents
            below[self.up[k]] += below[k]
        return [(k, self.up[k], self.depth[k], self.children[k], below[k]) for k in range(len(below))]


def words_in(turn: bytes) -> int:
    return int.from_bytes(turn[16:], "big")


class _Open:
    """A node whose subtree is being walked."""

    __slots__ = ("turn", "node", "depth", "least", "n", "children", "leaves", "weighted", "words", "ends", "waiting")

    def __init__(self, turn: bytes, node: int, depth: int):
        self.turn, self.node, self.depth = turn, node, depth
        self.least, self.n, self.children, self.leaves, self.weighted, self.words = None, 0, 0, 0, 0, 0
        self.ends, self.waiting = EMPTY, []


class _Walk:
    """Walks paths in order; ``rows`` are finished nodes and partial sums of skeleton nodes."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.open = [_Open(b"", 0, 0)]
        self.before = b""
        self.rows: list[tuple] = []

    def add(self, path: bytes, n: int, least: int, ends: str) -> None:
        common = shared_turns(self.before, path)
        while len(self.open) > common + 1:
            self.close()
        for k in range(common * TURN, len(path), TURN):
            top, turn = self.open[-1], path[k : k + TURN]
            node = self.skeleton.child.get((top.node, turn), -1) if top.node >= 0 else -1
            self.open.append(_Open(turn, node, top.depth + 1))
        top = self.open[-1]
        top.n, top.least, top.ends = top.n + n, least if top.least is None else min(top.least, least), ends
        self.before = path

    def close(self) -> None:
        own = self.open.pop()
        n_words = words_in(own.turn) if own.turn else 0
        own.weighted += own.n * n_words
        if own.node < 0:
            own.words += n_words
            own.leaves = own.leaves if own.children else 1
            for row in own.waiting:
                self.rows.append((*row[:4], own.least, *row[5:]))
        row = (own.node, -1, own.least, own.depth, None, own.n, own.children, own.leaves, own.weighted, own.words, own.ends)
        if not self.open:
            self.rows.append(row)
            return
        top = self.open[-1]
        if own.node >= 0:
            self.rows.append(row)
        elif top.node >= 0:
            self.rows.append((-1, top.node, *row[2:]))
        else:
            top.waiting.append(row)
        top.children += own.node < 0
        top.n, top.leaves = top.n + own.n, top.leaves + own.leaves
        top.least = own.least if top.least is None else min(top.least, own.least)
        top.weighted, top.words = top.weighted + own.weighted, top.words + own.words

    def end(self) -> None:
        if self.open[0].n or len(self.open) > 1:
            while self.open:
                self.close()


def _shard_nodes(paths: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """Finished nodes (``node`` -1) and partial sums, shard by shard."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)
    schema = pa.schema([
        (name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (x.split() for x in FINISHED.split(", "))
    ])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = shared.value.splits
        for batch in batches:
            shard = [bisect_right(splits, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], names=["path", "n", "least", "ends", "shard"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(shared.value)

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*walk.rows, strict=True), schema, strict=True)]
            walk.rows = []
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                walk.add(*row)
            if len(walk.rows) >= ROWS:
                yield flush()
        walk.end()
        if walk.rows:
            yield flush()

    marked = paths.mapInArrow(dealt, "path binary, n long, least long, ends string, shard int")
    return marked.repartition(shards, "shard").sortWithinPartitions("path").mapInArrow(walked, FINISHED)


def drawn_splitters(paths: DataFrame, shards: int | None) -> tuple[list[bytes], int]:
    """Splitters from paths drawn by their hash, about ``DRAWN`` for each shard, and the number of shards."""
    size = paths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("bytes")).first()
    if shards is None:
        at_least = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = min(SHARDS, max(at_least, size["bytes"] // TURN // SHARD_TURNS))
    parts = 1 << 30
    share = min(parts, -(-parts * DRAWN * shards // max(1, size["n"])))
    drawn = paths.filter(F.pmod(F.xxhash64("path"), F.lit(parts)) < share)
    cut = drawn.select(F.substring("path", 1, DEEPEST * TURN).alias("path")).distinct()
    return splitters([bytes(r["path"]) for r in cut.collect()], shards), shards


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row a node of the trie of ``paths`` (``conv``, each once, and ``path``).

    ``conv_id`` is the least member, ``parent_conv_id`` that of the parent, ``n_convs`` the
    members, ``n_children``, ``n_leaves`` of the subtree, ``saved_tokens`` its words that
    are shared, ``ends_sha256`` the digest of the ids that end at the node.
    """
    spark = paths.sparkSession
    each = written(ended(paths), "paths")
    splits, shards = drawn_splitters(each, shards)
    skeleton = Skeleton(splits)
    nodes = written(_shard_nodes(each, skeleton, shards), "trie")
    local = nodes.filter("node < 0").select(
        "up", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("weighted") - F.col("words")).alias("saved_tokens"), "ends_sha256",
    )
    fixed = spark.createDataFrame(skeleton.rows(), "node int, above int, depth long, inner int, below long")
    reduced = nodes.filter("node >= 0").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "weighted", "words")),
        # all but one of the parts have the digest of no ids
        F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))).alias("ends_sha256"),
    )
    n_children = F.col("n_children") + F.col("inner")
    spine = written(
        fixed.join(reduced, "node").select(
            "node", F.col("above").alias("up"), "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
            n_children.alias("n_children"),
            F.when(n_children == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
            (F.col("weighted") - F.col("words") - F.col("below")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        ),
        "spine",
    )
    # at most SHARDS * DEEPEST rows of two numbers
    tops = F.broadcast(spine.select(F.col("node").alias("up"), F.col("conv_id").alias("top_conv_id")))
    every = local.unionByName(spine.drop("node")).join(tops, "up", "left")
    return every.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "top_conv_id").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
