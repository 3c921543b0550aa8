"""Byte-level BPE: encode texts into token ids and decode ids into bytes.

Pieces (matches of the split pattern) of a slice that have not been met before are
dealt into buckets by length.  A bucket is a padded numpy matrix with a piece a row;
in each round every row merges its leftmost pair of minimum rank, found in a hash
table of pairs, and the row is compacted by one column.  Rows without a pair leave.

Null texts are empty and give no ids.  Texts of any length are encoded whole; a piece
longer than ``LONG_PIECE`` bytes is merged with a heap, as rounds over it would grow
with its square.  Repeated rows and extra columns pass through; ``out`` replaces a
column of that name.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.arrowtext import release, slices, texts

RANKS = "byte_bpe_50k.tiktoken"
#: Words that a worker remembers within a task.
REMEMBERED = 300_000
LONG_PIECE = 384
#: Cells of one padded matrix.
CELLS = 1 << 20
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Tokens by id, and merges of two ids in an open hash table."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for token, i in ranks.items():
            by_id[i] = token
        self.lengths = np.array([len(x) for x in by_id], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(by_id), dtype=np.uint8)
        pairs: dict[int, int] = {}
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = i
        self.pairs = pairs
        self._fill(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Linear probing, a round of inserts for all keys at once."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NONE, dtype=np.int32)
        left, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(left):
            free = self.values[at] == NONE
            self.keys[at[free]] = keys[left[free]]
            won = free & (self.keys[at] == keys[left])
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id, and so the rank, of each pair; ``NONE`` where none merges or a side is padding."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)
        shape, keys = keys.shape, keys.ravel()
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.values[at] != NONE))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            slot = at[open_]
            out[open_] = np.where(self.keys[slot] == keys[open_], self.values[slot], NONE)
            open_ = open_[(out[open_] == NONE) & (self.values[slot] != NONE)]
        return out.reshape(shape)


def merge_matrix(vocabulary: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All merges; ``ids`` holds bytes' ids, padded on the right with -1.

    Returns the rows in the order in which they were done, their numbers of ids, and
    these ids one after another.
    """
    order, sizes, flat = [], [], []
    rows = np.arange(len(ids))
    ranks = vocabulary.merged(ids[:, :-1], ids[:, 1:])
    while len(rows):
        each = np.arange(len(rows))
        at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
        best = ranks[each, at] if ranks.shape[1] else np.full(len(rows), NONE)
        if (over := best == NONE).any():
            finished = ids[over]
            order.append(rows[over])
            sizes.append((finished >= 0).sum(axis=1))
            flat.append(finished[finished >= 0])
            keep = np.flatnonzero(~over)
            rows, ids, ranks, at, best, each = rows[keep], ids[keep], ranks[keep], at[keep], best[keep], each[: len(keep)]
            if not len(rows):
                break
        ids[each, at] = best
        columns = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
        columns = columns[:-1]
        ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
        for column in (at - 1, at):
            ok = np.flatnonzero((column >= 0) & (column < ranks.shape[1]))
            c = column[ok]
            ranks[ok, c] = vocabulary.merged(ids[ok, c], ids[ok, c + 1])
    return np.concatenate(order), np.concatenate(sizes), np.concatenate(flat)


def merge_long(vocabulary: Vocabulary, piece: bytes) -> np.ndarray:
    """The same merges for one long piece: a heap of pairs over a linked list."""
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    n, pairs = len(ids), vocabulary.pairs
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get((ids[i] << 32) | ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i], ids[j] = rank, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and (b := after[a]) < n and (r := pairs.get((ids[a] << 32) | ids[b])) is not None:
                heapq.heappush(heap, (r, a, ids[a], ids[b]))
    return np.array([x for x in ids if x >= 0], dtype=np.int32)


def merge_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each piece's ids start, how many it has, and the ids."""
    starts, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    found, total = [], 0

    def keep(members: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        nonlocal total
        starts[members] = total + np.cumsum(counts) - counts
        sizes[members] = counts
        found.append(ids)
        total += len(ids)

    whole = np.array([vocabulary.ranks.get(x, -1) for x in pieces], dtype=np.int32)
    one = np.flatnonzero(whole >= 0)
    keep(one, np.ones(len(one), np.int64), whole[one])
    lengths = np.array([len(x) for x in pieces], dtype=np.int64)
    widths = np.where(lengths <= 16, lengths + (lengths & 1), 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
    widths[lengths > LONG_PIECE] = 0
    widths[whole >= 0] = 0
    for width in np.unique(widths[widths > 0]).tolist():
        bucket, step = np.flatnonzero(widths == width), max(1, CELLS // width)
        for begin in range(0, len(bucket), step):
            members = bucket[begin : begin + step]
            raw = b"".join([pieces[k].ljust(width, b"\0") for k in members.tolist()])
            ids = vocabulary.byte_ids[np.frombuffer(raw, np.uint8).reshape(len(members), width)]
            ids[np.arange(width) >= lengths[members][:, None]] = -1
            order, counts, merged = merge_matrix(vocabulary, ids)
            keep(members[order], counts, merged)
    for k in np.flatnonzero((lengths > LONG_PIECE) & (whole < 0)).tolist():
        ids = merge_long(vocabulary, pieces[k])
        keep(np.array([k]), np.array([len(ids)]), ids)
    return starts, sizes, np.concatenate(found)


class Encoder:
    """Encodes texts; remembers the ids of a bounded number of words.

    A piece never reaches over a space that something other than white space follows:
    the space begins the next piece.  So a text falls into words at its single spaces,
    and only words not met before are split by the pattern.  A word is kept without
    its leading space; a string without one (a text's first word, or a piece of a text
    with other white space after a space) is kept with a space at its end.
    """

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.split = Vocabulary(path), regex.compile(pattern).findall
        self.mixed = re.compile(r" \s").search if pattern == public_tokenizers.PATTERN else lambda text: True
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _words(self, text: str) -> list[str]:
        if self.mixed(text):
            return [x + " " for x in self.split(text)]
        words = text.split(" ")
        words[0] += " "
        return words

    def _learn(self, new: list[str]) -> None:
        split = [self.split(x[:-1] if x[-1:] == " " else " " + x) for x in new]
        pieces = list(set().union(*split))
        starts, sizes, flat = merge_pieces(self.vocabulary, [x.encode() for x in pieces])
        at = dict(zip(pieces, range(len(pieces)), strict=True))
        ends = np.cumsum([0, *map(len, split)])
        ids, offsets = _gather(starts, sizes, flat, np.fromiter(map(at.__getitem__, chain.from_iterable(split)), np.int64, int(ends[-1])), ends)
        first = len(self.starts)
        self.starts = np.concatenate([self.starts, len(self.flat) + offsets[:-1]])
        self.sizes = np.concatenate([self.sizes, np.diff(offsets)])
        self.flat = np.concatenate([self.flat, ids])
        self.place.update(zip(new, range(first, first + len(new)), strict=True))

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the documents' offsets into them."""
        words = [self._words(x) for x in docs]
        if len(self.place) > REMEMBERED:
            self.forget()
        if new := list(set().union(*words).difference(self.place)):
            self._learn(new)
        ends = np.cumsum([0, *map(len, words)])
        places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, ends[-1])
        return _gather(self.starts, self.sizes, self.flat, places, ends)


def _gather(starts, sizes, flat, places, ends) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[starts[p]:][:sizes[p]]`` of ``places``, and where each of ``ends`` falls in them."""
    counts = sizes[places]
    upto = np.concatenate([[0], np.cumsum(counts)])
    return flat[np.repeat(starts[places] - upto[:-1], counts) + np.arange(upto[-1])], upto[ends]


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all ids one after another, and the documents' offsets into them."""
    return _gather(vocabulary.starts, vocabulary.lengths, vocabulary.bytes, ids, offsets)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c not in columns]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns.values()], names=[*kept, *columns])


def _schema(df: DataFrame, **columns: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in columns]
    return T.StructType([*kept, *(T.StructField(c, kind) for c, kind in columns.items())])


def encode(
    df: DataFrame, text: str = "text", out: str = "ids", decoded: str | None = None,
    path: str | None = None, pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``df`` with the token ids of ``text`` as an array; ``decoded`` adds the bytes the ids decode to."""
    path = path or public_tokenizers.path(RANKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                ids, offsets = own.encode(texts(part, text))
                columns = {out: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))}
                if decoded:
                    columns[decoded] = _binary(*decode_ids(own.vocabulary, ids, offsets))
                yield _with(part, columns)
        own.forget()
        release()

    kinds = {out: T.ArrayType(T.IntegerType())} | ({decoded: T.BinaryType()} if decoded else {})
    return df.mapInArrow(work, _schema(df, **kinds))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the bytes that each array of ids stands for; null is empty."""
    path = path or public_tokenizers.path(RANKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, public_tokenizers.PATTERN).vocabulary
        for batch in batches:
            lists = batch.column(ids)
            sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield _with(batch, {out: _binary(*decode_ids(own, flat, np.concatenate([[0], np.cumsum(sizes)])))})

    return df.mapInArrow(work, _schema(df, **{out: T.BinaryType()}))


def _binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def digests(coded: DataFrame, *kept: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Counts and digests of each row's ids and of the bytes they decode to."""
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    return coded.select(
        *kept,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
