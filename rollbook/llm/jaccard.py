"""Documents linked by the Jaccard similarity of their word shingles, and their components.

Words are runs without white space, A-Z in lower case; a document's set holds its
distinct shingles (the whole text if it has fewer words) as 64-bit hashes, and an equal
set has an equal 64-bit digest, the document's node.  Equal sets are one node, so
copies are never compared.

1. One pass gives each document's node and size, and a sketch: a fixed number of
   counters of all documents' shingles by hash.  Counters are summed in Spark.
2. Sets are ordered by (counter, hash).  Two sets similar enough share a shingle within
   their first n - ceil(t * n) + 1 ones, whatever the counters say; and as these are the
   shingles of lowest counters, passages that many documents share, which raise theirs
   beyond what chance does, hardly ever come into play.  Nodes that share such
   a shingle are connected into groups, which contain every link; where only two nodes
   of near sizes share it, their bitmaps (see below) have to leave the pair open.
   The more texts there are, the more of them share such a shingle by chance alone, until
   most are one group.  Groups of more than two tiles are therefore formed anew by parts of
   sets: hashes deal a set into more parts than two similar sets can differ in, so some
   parts are equal, and those with the most shingles that are not common are compared.
3. A group's nodes are dealt into tiles by size; tiles whose sizes are too far apart are
   not paired.  In a pair of tiles, hashed bitmaps bound the overlap of two sets from
   above by bit counts.  Pairs left open by their bitmaps give narrower groups.
4. In tiles of these, pairs that pass the bound are settled by intersecting the sorted
   arrays.  Nodes that are connected already are not compared again.
5. In both, tiles next to each other come first; further pairs are worked on only if what
   they hold is not yet one component.

No pair is lost: every step before the exact one keeps a superset of the links.  Only
links that join two components are emitted, fewer than nodes in a tile pair.

Null and blank texts have an empty set, link with nothing and are their own component.
Rows with a null id take part; a component's id is its least id that is not null.
Repeated rows are copies of each other.  Very long texts are read whole; an empty table gives no rows;
columns other than id and text are ignored by ``linked`` and kept, whatever their names, by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.arrowtext import buffers, release, slices
from rollbook.llm.graph import components
from rollbook.llm.storage import swept, written

SHINGLE = 4
#: Similarity as a fraction of integers.
LEAST = (85, 100)
#: Counters of the sketch, and counters of one row of it.
CELLS, CHUNK = 1 << 20, 1 << 12
#: Sum over the nodes of a tile of (set size + NODE_WEIGHT).
TILE_WEIGHT, NODE_WEIGHT = 400_000, 400
#: Sums of two sets' sizes are in one class up to this ratio; sets have one part in ``SPARE`` more than they need.
CLASS_RATIO, SPARE = (7, 5), 4
#: Bits of the filter that picks the texts to read again.
FILTER_BITS = 1 << 23
#: Bits of a set's bitmap.
LEAST_BITS, MOST_BITS = 1 << 8, 1 << 18
U = np.uint64

# ---------------------------------------------------------------- hashing

_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits depend on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, dtype=U)
    if n > 1:
        out[1:] = base & (2**64 - 1)
        np.multiply.accumulate(out, out=out)
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mixed(np.arange(1, 257, dtype=U) * U(_BASE))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_INVERSE = pow(_BASE, -1, 2**64)


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts one after another, and the texts' offsets into them."""
    n = len(flat)
    word = ~_SPACE[flat]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:n] | ~np.concatenate([[False], word[:-1]])))
    last = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]])))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[_LOWER[flat]] * _powers(n, _BASE), dtype=U)])
    lengths = (last + 1 - starts).astype(U)
    hashes = mixed((sums[last + 1] - sums[starts]) * _powers(n + 1, _INVERSE)[starts] + lengths * U(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets)


def _closed(total: np.uint64, n: int) -> np.ndarray:
    """A sum of hashes and the number of its parts as one hash."""
    return mixed(np.array([(int(total) + n * _BASE) & (2**64 - 1)], dtype=U))


_PLACE = mixed(np.arange(101, 101 + 64, dtype=U))


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, at = word_hashes(flat, offsets)
    windows = np.zeros(max(0, len(hashes) - size + 1), dtype=U)
    for k in range(size):
        windows += hashes[k : k + len(windows)] * (_PLACE[k] | U(1))
    windows = mixed(windows)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            out.append(_closed((hashes[a:b] * (_PLACE[: b - a] | U(1))).sum(dtype=U), b - a))
        else:
            out.append(np.zeros(0, dtype=U))
    return out


def node_of(own: np.ndarray) -> int:
    """The digest of a sorted set."""
    return int(_closed((mixed(own ^ U(0xA0761D6478BD642F)) * (own | U(1))).sum(dtype=U), len(own)).view(np.int64)[0])


# ---------------------------------------------------------------- the passes over texts


def profiles(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, n, node) per document, and from each task rows (chunk, counts) of the sketch."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
        T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, key_type = np.zeros(CELLS, dtype=np.int64), None
        for batch in batches:
            key_type = batch.column(key).type
            for part in slices(batch, text):
                sets = shingle_sets(*buffers(part, text), size)
                if sets:
                    cells += np.bincount((np.concatenate(sets) & U(CELLS - 1)).astype(np.int64), minlength=CELLS)
                m = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()),
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=schema.names)
        if key_type is not None:
            chunks = [c for c in range(CELLS // CHUNK) if cells[c * CHUNK : (c + 1) * CHUNK].any()]
            m = len(chunks)
            counts = [cells[c * CHUNK : (c + 1) * CHUNK].astype(np.uint32).tobytes() for c in chunks]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, key_type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                 pa.array(chunks, pa.int32()), pa.array(counts, pa.binary())], names=schema.names)

    return docs.select(key, text).mapInArrow(work, schema)


def commonness(read: DataFrame) -> np.ndarray:
    """The sketch: how many shingles of all documents' sets fall into each cell."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = np.frombuffer(counts, dtype=np.uint32 if len(counts) == 4 * CHUNK else np.uint64)
                sums[chunk] = sums.get(chunk, 0) + own.astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["chunk", "counts"])

    rows = read.filter("chunk IS NOT NULL").select("chunk", "counts")
    summed = rows.repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    cells = np.zeros(CELLS, dtype=np.uint64)
    for row in summed.toLocalIterator():  # CELLS counters in all
        cells[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], dtype=np.uint64)
    return np.minimum(cells, 2**32 - 1).astype(np.uint32)


def prefix_size(n: int, least: tuple[int, int]) -> int:
    return n - -(-least[0] * n // least[1]) + 1


def tokens_of(docs: DataFrame, text: str, size: int, held: np.ndarray, chosen: Callable, passing: Broadcast | None = None) -> DataFrame:
    """(token, n, node): what ``chosen`` takes of each set of n, given ``held``; a task gives a node once.

    ``passing`` lets through the rows whose column ``bit`` it has.
    """
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, given = shared.value, set()
        for batch in batches:
            if passing is not None:
                batch = batch.filter(pa.array(passing.value[batch.column("bit").to_numpy()] == 1))
            for part in slices(batch, text):
                tokens, nodes, totals, sizes = [], [], [], []
                for own in shingle_sets(*buffers(part, text), size):
                    node = node_of(own)
                    if not len(own) or node in given:
                        continue
                    given.add(node)
                    tokens.append(chosen(own, known))
                    nodes.append(node)
                    totals.append(len(own))
                    sizes.append(len(tokens[-1]))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(totals, np.int32), sizes)),
                         pa.array(np.repeat(np.array(nodes, np.int64), sizes))], names=["token", "n", "node"])
        given.clear()
        release()

    return docs.mapInArrow(work, "token long, n int, node long")


def prefix_tokens(docs: DataFrame, text: str, size: int, least: tuple[int, int], common: np.ndarray) -> DataFrame:
    """(token, n, node): the rarest shingles of each set of n; a task gives a node once."""

    def first(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        count = counts[(own & U(CELLS - 1)).astype(np.int64)]
        return own[np.argsort(count, kind="stable")[: prefix_size(len(own), least)]]

    return tokens_of(docs.select(text), text, size, common, first)


def size_classes(n: int, least: tuple[int, int]) -> list[int]:
    """The largest sum of each class that the sizes of a set of n and of one similar enough can add up to."""
    low, high, top, out = n - -(-least[0] * n // least[1]), n + least[1] * n // least[0], 1, []
    while top < high:
        top = max(top + 1, top * CLASS_RATIO[0] // CLASS_RATIO[1])
        if top >= low:
            out.append(top)
    return out


def part_signatures(own: np.ndarray, rare: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Hashes of parts of a sorted set, of which any two sets similar enough have one in common.

    Sets whose sizes add up to s or less differ in s * (1 - t) / (1 + t) shingles at most, and
    in as many parts.  Hashes deal both into that many parts, one and some spare ones, so more
    parts than the spare ones are equal.  Parts are ordered by how many shingles of theirs are
    ``rare``, whose own hash decides between equal numbers; the last ones, as many as are spare, are left out: of
    the equal parts the first is among neither set's.
    """
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(own ^ U(0x8CB92BA72F3D8DD7)), dtype=U)])
    counted = np.concatenate([[0], np.cumsum(rare[(own & U(CELLS - 1)).astype(np.int64)])])
    out = []
    for top in size_classes(len(own), least):
        differ = top * (least[1] - least[0]) // (least[1] + least[0])
        parts = differ + 1 + differ // SPARE
        ends = np.searchsorted(((own >> U(32)) * U(parts)) >> U(32), np.arange(parts + 1, dtype=U))
        place = np.arange(parts, dtype=U) * U(0x9FB21C651E98DF25) + U(top * 0xD6E8FEB86659FD93 & (2**64 - 1))
        hashes = mixed((sums[ends[1:]] - sums[ends[:-1]]) ^ mixed(place))
        out.append(hashes[np.lexsort((hashes, -(counted[ends[1:]] - counted[ends[:-1]])))[: differ + 1]])
    return np.concatenate(out)


def part_tokens(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int, least: tuple[int, int], common: np.ndarray) -> DataFrame:
    """(token, n, node): the parts of the sets of ``wanted`` (key) and of few others."""
    # more than chance puts into a cell
    mean = common.mean(dtype=np.float64)
    rare = common <= mean + 6 * np.sqrt(mean) + 6
    passing = docs.sparkSession.sparkContext.broadcast(key_filter(wanted, key))
    return tokens_of(docs.select(filter_bit(key).alias("bit"), text), text, size, rare, lambda own, known: part_signatures(own, known, least), passing)


def group_edges(tokens: DataFrame, least: tuple[int, int]) -> DataFrame:
    """u, v, alone: nodes that share a token; a pair of its own, or a star of three or more.

    A token's nodes are sorted by size and cut into runs where the next size is too far
    from the last.  Between two nodes of sizes near enough there is no cut, so each run
    can be one star, and no link reaches over a cut.  Rows stream through; of a run that
    goes on in the next batch the first and the last row are held.
    """

    def edges(node: np.ndarray, hub: np.ndarray, alone: np.ndarray) -> pa.RecordBatch:
        keep = node != hub
        found = np.unique(np.column_stack([node[keep], hub[keep], alone[keep]]), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy()), pa.array(found[:, 2] == 1)], names=["u", "v", "alone"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the open run: its token, last size, last node, hub, length
        token_, n_, last_, hub_, length_ = None, 0, 0, 0, 0

        def second() -> Iterator[pa.RecordBatch]:
            if length_ == 2:
                yield edges(np.array([last_]), np.array([hub_]), np.array([1]))

        for batch in batches:
            token, n, node = (batch.column(c).to_numpy() for c in ("token", "n", "node"))
            # copies give a node once a task: equal rows lie next to each other
            fresh = np.ones(len(token), dtype=bool)
            fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            if len(token) and token[0] == token_ and node[0] == last_:
                fresh[0] = False
            token, n, node = token[fresh], n[fresh], node[fresh]
            if not len(token):
                continue
            n = n.astype(np.int64)
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (least[1] * n[:-1] < least[0] * n[1:])])
            goes_on = token_ == token[0] and least[1] * n_ >= least[0] * n[0]
            if not goes_on:
                yield from second()
                length_ = 0
            starts = np.flatnonzero(new)
            lengths = np.diff([*starts, len(token)])
            hubs = node[starts].copy()
            total = lengths.copy()
            if goes_on:
                hubs[0] = hub_
                total[0] += length_
                if length_ == 2:  # now it has more
                    yield edges(np.array([last_]), np.array([hub_]), np.array([0]))
            run = np.cumsum(new) - 1
            hub = hubs[run]
            closed = run < len(starts) - 1
            ready = closed | (total[run] > 2)
            if ready.any():
                yield edges(node[ready], hub[ready], (total[run] == 2)[ready].astype(np.int64))
            token_, n_, last_, hub_, length_ = token[-1], n[-1], node[-1], hubs[-1], int(total[-1])
        yield from second()

    sorted_ = tokens.repartition("token").sortWithinPartitions("token", "n", "node")
    return sorted_.mapInArrow(work, "u long, v long, alone boolean").distinct()


def open_pairs(edges: DataFrame, sets: DataFrame, sizes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """u, v: the stars, and of the pairs those that their bitmaps leave open."""
    marks = sets.select("node", "marks").join(sizes, "node").select("node", F.struct("n", "marks").alias("held"))
    pairs = edges.filter("alone").select("u", "v").distinct()
    both = pairs.join(marks.select(F.col("node").alias("u"), F.col("held").alias("held_u")), "u")
    both = both.join(marks.select(F.col("node").alias("v"), F.col("held").alias("held_v")), "v")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, left, right = (batch.column(c).to_pylist() for c in ("u", "v", "held_u", "held_v"))
            kept = []
            for k, (a, b) in enumerate(zip(left, right, strict=True)):
                a, b = sorted((a, b), key=lambda x: x["n"])
                n = np.array([a["n"], b["n"]])
                most = Bitmaps([a["marks"], b["marks"]]).most_shared(0, np.array([1]), n)[0]
                if most * (least[0] + least[1]) >= least[0] * n.sum():
                    kept.append(k)
            yield pa.RecordBatch.from_arrays([pa.array([u[k] for k in kept], pa.int64()), pa.array([v[k] for k in kept], pa.int64())], names=["u", "v"])

    passed = both.select("u", "v", "held_u", "held_v").mapInArrow(work, "u long, v long")
    return edges.filter("NOT alone").select("u", "v").unionAll(passed)


def marks_of(own: np.ndarray) -> bytes:
    """A bitmap of the set with four to eight bits a shingle; half of one laid over the other is a smaller bitmap."""
    bits = 1 << int(np.clip(4 * len(own) - 1, LEAST_BITS - 1, MOST_BITS - 1)).bit_length()
    row = np.zeros(bits, dtype=np.uint8)
    row[((own >> U(20)) & U(bits - 1)).astype(np.int64)] = 1
    return np.packbits(row, bitorder="little").tobytes()


def filter_bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_BITS)).cast("int")


def key_filter(wanted: DataFrame, key: str) -> np.ndarray:
    """A byte for each of FILTER_BITS: 1 where a wanted key falls."""
    cells = wanted.select(filter_bit(key).alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, bit & 63))").alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    found = cells.toPandas()  # at most FILTER_BITS / 64 rows
    bits[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return np.unpackbits(bits.view(np.uint8), bitorder="little")


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int, whole: bool) -> DataFrame:
    """(node, marks), and if ``whole`` the set as ``own``, of the nodes of ``wanted`` (key), read again from the texts.

    A bitmap of fixed size lets through the rows whose key is wanted and few others; a
    key's repeated rows give their sets each.
    """
    bit = filter_bit(key)
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(wanted, key))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = shared.value
        for batch in batches:
            kept = batch.filter(pa.array(passing[batch.column("bit").to_numpy()] == 1))
            for part in slices(kept, text):
                sets = shingle_sets(*buffers(part, text), size)
                columns = {"node": pa.array([node_of(s) for s in sets], pa.int64()), "marks": pa.array([marks_of(s) for s in sets], pa.binary())}
                if whole:
                    columns["own"] = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(bit.alias("bit"), text).mapInArrow(work, "node long, marks binary" + ", own binary" * whole)


# ---------------------------------------------------------------- tiles


def tiled(members: DataFrame) -> DataFrame:
    """Nodes (node, component, n) with ``tile``, numbered by size within their component.

    Sizes are counted per component and summed up over its distinct sizes; nodes of one
    size are spread over the places of that size by their hash.
    """
    from pyspark.sql import Window

    counts = members.groupBy("component", "n").agg(F.count(F.lit(1)).alias("rows_"))
    before = Window.partitionBy("component").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.col("rows_") * (F.col("n") + NODE_WEIGHT)
    placed = counts.select("component", "n", weight.alias("weight_"), F.coalesce(F.sum(weight).over(before), F.lit(0)).alias("before_"))
    at = F.col("before_") + F.pmod(F.xxhash64("node"), F.col("weight_"))
    return members.join(placed, ["component", "n"]).select("node", "component", "n", F.floor(at / TILE_WEIGHT).cast("int").alias("tile"))


def tile_pairs(tiles: DataFrame, least: tuple[int, int]) -> DataFrame:
    """component, a, b: pairs of tiles, a <= b, that can hold a link."""
    spans = tiles.groupBy("component", "tile").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    a = spans.select("component", F.col("tile").alias("a"), F.col("hi").alias("hi_a"))
    b = spans.select("component", F.col("tile").alias("b"), F.col("lo").alias("lo_b"))
    return a.join(b, "component").filter((F.col("a") <= F.col("b")) & (least[1] * F.col("hi_a") >= least[0] * F.col("lo_b"))).select("component", "a", "b")


class Bitmaps:
    """Bitmaps of different lengths, which are folded to those of smaller sets."""

    def __init__(self, marks: list[bytes]):
        self.length = np.array([len(m).bit_length() for m in marks])
        self.place = np.zeros(len(marks), dtype=np.int64)
        self.held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(self.length).tolist():
            rows = np.flatnonzero(self.length == length)
            self.place[rows] = np.arange(len(rows))
            full = np.frombuffer(b"".join([marks[k] for k in rows.tolist()]), dtype=U).reshape(len(rows), -1)
            self.held[length, 0] = (full, np.bitwise_count(full).sum(axis=1, dtype=np.int64))

    def folded(self, length: int, times: int) -> tuple[np.ndarray, np.ndarray]:
        """All bitmaps of a length folded to half of it so many times, and their numbers of ones."""
        if (length, times) not in self.held:
            rows, _ = self.folded(length, times - 1)
            half = rows.shape[1] // 2
            rows = rows[:, :half] | rows[:, half:]
            self.held[length, times] = (rows, np.bitwise_count(rows).sum(axis=1, dtype=np.int64))
        return self.held[length, times]

    def most_shared(self, i: int, others: np.ndarray, n: np.ndarray) -> np.ndarray:
        """No set of ``others``, none smaller, shares more with set i."""
        length, out = int(self.length[i]), np.zeros(len(others), dtype=np.int64)
        own, own_ones = (x[self.place[i]] for x in self.folded(length, 0))
        lengths = self.length[others]
        for other in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == other)
            rows, ones = (x[self.place[others[at]]] for x in self.folded(other, other - length))
            both = np.bitwise_count(rows & own).sum(axis=1, dtype=np.int64)
            # every bit that only one set has is a shingle that the other lacks
            out[at] = both + np.minimum(n[i] - own_ones, n[others[at]] - ones)
        return out


def links_in_pair(
    nodes: np.ndarray, tile: np.ndarray, n: np.ndarray, marks: list[bytes], sets: list[np.ndarray] | None, diagonal: bool, least: tuple[int, int]
) -> list[tuple[int, int]]:
    """Links that join components among the sets of a tile, or between two tiles.

    Without ``sets`` every pair counts that its bitmaps leave open.
    """
    order = np.lexsort((nodes, n))
    nodes, tile, n, marks = nodes[order], tile[order], n[order], [marks[k] for k in order]
    sets = [sets[k] for k in order] if sets else None
    bitmaps = Bitmaps(marks)
    label = np.arange(len(nodes))
    ends = np.searchsorted(least[0] * n, least[1] * n, side="right")  # sizes up to n / t
    out = []
    for i in range(len(nodes) - 1):
        own = slice(i + 1, int(ends[i]))
        near = (label[own] != label[i]) if diagonal else (label[own] != label[i]) & (tile[own] != tile[i])
        others = np.flatnonzero(near) + i + 1
        if not len(others):
            continue
        # intersection * least[1] >= union * least[0]
        others = others[bitmaps.most_shared(i, others, n) * (least[0] + least[1]) >= least[0] * (n[i] + n[others])]
        for j in others.tolist():
            if label[j] == label[i]:
                continue
            if sets:
                small, large = sets[i], sets[j]
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                inter = int((large[at] == small).sum())
                if least[1] * inter < least[0] * (len(small) + len(large) - inter):
                    continue
            out.append((int(nodes[j]), int(nodes[i])))
            label[label == label[j]] = label[i]
    return out


def links(tiles: DataFrame, sets: DataFrame, pairs: DataFrame, least: tuple[int, int], exact: bool) -> DataFrame:
    """u, v: links found in pairs of tiles; ``tiles`` has node, component, n, tile."""
    data = ["marks", "own"] if exact else ["marks"]
    ends = pairs.withColumn("tile", F.explode(F.array_distinct(F.array("a", "b"))))
    rows = tiles.join(ends, ["component", "tile"]).join(sets.select("node", *data), "node")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, seen = None, [], set()

        def done() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                nodes, tile, n = (np.array([x[k] for x in held], np.int64) for k in range(3))
                sets_ = [np.frombuffer(x[4], dtype=U) for x in held] if exact else None
                found = links_in_pair(nodes, tile, n, [x[3] for x in held], sets_, now[1] == now[2], least)
                if found:
                    u, v = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("component", "a", "b")), strict=True)
            values = zip(*(batch.column(c).to_pylist() for c in ("node", "tile", "n", *data)), strict=True)
            for key, value in zip(keys, values, strict=True):
                if key != now:
                    yield from done()
                    now, held, seen = key, [], set()
                if value[0] not in seen:
                    seen.add(value[0])
                    held.append(value)
        yield from done()
        held.clear()
        release()

    dealt = rows.select("component", "a", "b", "tile", "node", "n", *data)
    return dealt.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b").mapInArrow(work, "u long, v long")


def connected(members: DataFrame, sets: DataFrame, least: tuple[int, int], exact: bool) -> DataFrame:
    """(node, component): what links join; ``members`` has node, component, n."""
    tiles = written(tiled(members), "tiles")
    pairs = written(tile_pairs(tiles, least), "pairs")
    near = F.col("b") - F.col("a") <= 1
    found = written(links(tiles, sets, pairs.filter(near), least, exact), "links")
    far = pairs.filter(~near)
    if not far.isEmpty():
        # tiles that hold one component of the links so far need no pair within it
        part = components(found).withColumnRenamed("component", "part")
        parts = tiles.join(part, "node", "left").withColumn("part", F.coalesce("part", "node"))
        one = parts.groupBy("component", "tile").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
        pure = written(one.select("component", "tile", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("part")), "pure")
        a = pure.select("component", F.col("tile").alias("a"), F.col("part").alias("part_a"))
        b = pure.select("component", F.col("tile").alias("b"), F.col("part").alias("part_b"))
        open_ = far.join(a, ["component", "a"]).join(b, ["component", "b"])
        open_ = open_.filter("part_a IS NULL OR part_b IS NULL OR part_a <> part_b").select("component", "a", "b")
        found = found.unionAll(written(links(tiles, sets, open_, least, exact), "links"))
    return written(components(found), "components")


# ---------------------------------------------------------------- all together


def narrowed(
    members: DataFrame, grouped: DataFrame, marks: DataFrame, docs: DataFrame, key: str, text: str, size: int, least: tuple[int, int], common: np.ndarray
) -> DataFrame:
    """``members`` (node, component, n), those in groups of more than two tiles in the groups that their parts form."""
    weights = members.groupBy("component").agg(F.sum(F.col("n") + NODE_WEIGHT).alias("weight_"))
    large = written(weights.filter(F.col("weight_") > 2 * TILE_WEIGHT).select("component"), "large", files=1)
    if large.isEmpty():
        return members
    crowd = written(members.join(large, "component", "left_semi"), "crowd")
    swept(docs.sparkSession)  # the prefixes' files, before those of the parts come
    tokens = part_tokens(docs, grouped.join(crowd.select("node"), "node").select(key), key, text, size, least, common)
    edges = written(group_edges(tokens, least), "part-edges")
    near = written(open_pairs(edges, marks, crowd.select("node", "n"), least), "open-parts")
    again = crowd.select("node", "n").join(components(near), "node").select("node", "component", "n")
    return members.join(large, "component", "left_anti").select("node", "component", "n").unionAll(again)


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """Per document: key, ``n`` (set size), ``node`` (of its set) and ``component`` (the least key reachable)."""
    read = written(profiles(docs, key, text, size), "profiles")
    documents = read.filter("chunk IS NULL").select(key, "n", "node")
    common = commonness(read)
    tokens = prefix_tokens(docs, text, size, least, common)
    edges = written(group_edges(tokens, least), "token-edges")
    nodes = edges.select(F.col("u").alias("node")).unionAll(edges.select(F.col("v").alias("node"))).distinct()
    sizes = documents.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min(key).alias(key))
    grouped = written(sizes.join(nodes, "node"), "grouped")
    marks = written(sets_of(docs, grouped.select(key), key, text, size, whole=False), "marks")
    # written, so that no task needs two Python workers
    near = written(open_pairs(edges, marks, grouped.select("node", "n"), least), "open-pairs")
    groups = components(near)
    members = written(grouped.join(groups, "node").select("node", "component", "n"), "members")
    members = narrowed(members, grouped, marks, docs, key, text, size, least, common)
    open_ = connected(written(members, "narrowed"), marks, least, exact=False)
    # few nodes are left now: only their sets are read again and moved
    last = written(grouped.join(open_, "node"), "last")
    sets = written(sets_of(docs, last.select(key), key, text, size, whole=True), "sets")
    final = connected(last.select("node", "component", "n"), sets, least, exact=True)
    least_key = grouped.select("node", key).join(final, "node").groupBy("component").agg(F.min(key).alias("least_"))
    named = final.join(least_key, "component").select("node", "least_")
    own = sizes.select("node", F.col(key).alias("own_"))
    by_node = own.join(named, "node", "left").select("node", F.coalesce("least_", "own_").alias("component"))
    joined = documents.filter("n > 0").join(by_node, "node").select(key, "n", "node", "component")
    return joined.unionAll(documents.filter("n = 0").select(key, "n", "node", F.col(key).alias("component")))


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, least: tuple[int, int] = LEAST
) -> DataFrame:
    """One document of each component, that of least key, and all documents without words; columns as they were.

    Documents that share an id are told apart by their texts; of fully repeated ones one stays.
    """
    own = F.struct(F.col(key).alias("key"), F.md5(F.col(text).cast("binary")).alias("digest"))
    blank = F.col(text).isNull() | ~F.col(text).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.filter(~blank).withColumn("own_", own)
    found = written(
        linked(keyed.select("own_", text), "own_", text, size, least)
        .groupBy("own_").agg(F.first("component").alias("component"), F.count(F.lit(1)).alias("rows_")),
        "components",
    )
    # Most documents are alone: a bitmap of fixed size tells them without moving a text.
    first = F.col("own_") == F.col("component")
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(found.filter(~first | (F.col("rows_") > 1)), "own_"))

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        touched = shared.value
        for batch in batches:
            yield batch.set_column(1, "touched", pa.array(touched[batch.column("bit").to_numpy()] == 1))

    marked = keyed.select(F.struct(*docs.columns, "own_").alias("row"), filter_bit("own_").alias("bit"))
    marked = marked.select("row", "bit").mapInArrow(untouched, T.StructType([marked.schema["row"], T.StructField("touched", T.BooleanType())]))
    alone = marked.filter(~F.col("touched")).select("row.*").drop("own_")
    rest = marked.filter("touched").select("row.*")
    kept = rest.join(found.filter(first).select(F.col("own_").alias("first_")), F.col("own_") == F.col("first_"), "left_semi")
    return alone.unionByName(kept.dropDuplicates(["own_"]).drop("own_")).unionByName(docs.filter(blank))
