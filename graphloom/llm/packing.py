"""Packing token sequences with Karmarkar-Karp multiway differencing.

Whole windows of a document are sequences of their own.  What is left is cut
into small pieces and partitioned, a block of windows at a time, into windows
of near-equal sums: the two partial partitions with the largest spread are
merged with opposing imbalances until one is left.  If its fullest window
exceeds the capacity, the number of windows rises and the block is partitioned
again.  Blocks never cross tasks, so packing needs no shuffle.
"""
from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.tokens import chunks, words

CAPACITY = 2048
END_ID = 1
BLOCK_WINDOWS = 64  # windows partitioned together
MAX_PIECE = 256  # remainders are cut into pieces of at most this many ids
SLACK = 8  # ids per window a block is planned below capacity
CACHE_BYTES = 80 << 20  # what a task remembers of words, their pieces and ids
CHUNK_BYTES = 2 << 20  # text a task tokenizes at once
PIECES = 1 << 14  # pieces of words given to the model at once
_SEQUENCE_SHIFT = 40  # sequence_id = partition << 40 | number in the partition


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, sums) by largest differencing with ``windows`` sets."""
    n = len(sizes)
    sums: list[np.ndarray] = []
    for s in sizes:
        v = np.zeros(windows, np.int64)
        v[0] = s  # sums are kept in falling order
        sums.append(v)
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]  # fullest meets emptiest
        order = np.argsort(-total, kind="stable")
        v = total[order]
        merged.append((a, b, order))
        sums[a] = sums[b] = None
        sums.append(v)
        heapq.heappush(heap, (-int(v[0] - v[-1]), n + len(merged) - 1))
    root = n + len(merged) - 1
    slot: dict[int, np.ndarray] = {root: np.arange(windows)}
    out = np.zeros(n, np.int64)
    for k in range(len(merged) - 1, -1, -1):
        a, b, order = merged[k]
        mine = slot.pop(n + k)
        place = np.empty(windows, np.int64)
        place[order] = mine  # where each window of ``a`` (before sorting) ends up
        slot[a], slot[b] = place, place[::-1]
    for i in range(n):
        out[i] = slot[i][0]
    final = np.zeros(windows, np.int64)
    np.add.at(final, out, np.asarray(sizes, np.int64))
    return out, final


def partition(sizes: list[int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Window of each item, and the number of windows: the smallest count from
    the sum's lower bound up for which differencing keeps within capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place, sums = differencing(sizes, windows)
        if int(sums.max(initial=0)) <= capacity:
            return place, windows
        windows += 1


class Packer:
    """Packs a stream of (key, ids) of one task; yields finished pieces
    (key, start, ids, doc_tokens, sequence number, offset)."""

    def __init__(self, capacity: int, block: int, max_piece: int, slack: int):
        self.capacity, self.block, self.max_piece = capacity, block, max_piece
        self.target = block * (capacity - slack)
        self.items: list[tuple] = []
        self.held = 0
        self.sequence = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        n, cap = len(ids), self.capacity
        whole = n - n % cap
        for start in range(0, whole, cap):
            yield key, start, ids[start : start + cap], n, self.sequence, 0
            self.sequence += 1
        start = whole
        while start < n:
            size = min(self.max_piece, n - start, self.target - self.held)
            self.items.append((key, start, ids[start : start + size], n))
            self.held += size
            start += size
            if self.held >= self.target:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.items:
            return
        place, windows = partition([len(x[2]) for x in self.items], self.capacity)
        at = [0] * windows
        numbers = {w: self.sequence + i for i, w in enumerate(np.unique(place).tolist())}
        for (key, start, ids, n), w in zip(self.items, place.tolist()):
            yield key, start, ids, n, numbers[w], at[w]
            at[w] += len(ids)
        self.sequence += len(numbers)
        self.items, self.held = [], 0


def _strings(values: pa.Array) -> list[str]:
    """``to_pylist`` without a scalar object per value."""
    return values.to_numpy(zero_copy_only=False).tolist()


class WordTokenizer:
    """Ids of texts through the ids of their distinct words.

    White space only separates tokens in this vocabulary, so a text's ids are
    its words' ids in order.  Words of ASCII and Latin letters are split by the
    tokenizer's own pattern here, all at once, and their distinct pieces given
    to its BPE model directly; any other word goes through the whole tokenizer.
    """

    # Fixed values of the tokenizer file: its split pattern for the plain words below (the
    # space between two words is a piece without ids), and what ends a piece's last token.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ ]+| "
    PLAIN = r"^[\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ž]+$"
    PIECE = r"^[a-z]+$"  # words that are pieces themselves
    END = "</w>"

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)  # takes pieces joined by spaces
        self.bare.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.split = re.compile(self.SPLIT).findall
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.last[[i for t, i in vocabulary.items() if t.endswith(self.END)]] = True
        # byte-level alphabet: printable bytes stand for themselves, others follow from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        table = {b: b for b in shown}
        table |= {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in table)}
        self.alphabet = {b: chr(c) for b, c in table.items()}
        self.forget()

    def forget(self) -> None:
        """Empty the memory of words; a worker outlives its task."""
        self.numbers: dict[str, int] = {" ": 0}  # of words and pieces
        self.ids = np.empty(0, np.uint32)  # of all numbers, one after the other
        self.sizes = np.zeros(1, np.int32)  # how many ids a number has
        self.added: list[str] = []  # what was numbered last
        self.room = CACHE_BYTES

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the numbers, one after the other; how many there are before each, and in all)."""
        n = self.sizes[numbers]
        bounds = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        first = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        at = np.repeat(first[numbers] - bounds[:-1], n)
        at += np.arange(len(at))
        return self.ids[at], bounds

    def _add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.numbers.update(zip(keys, range(len(self.sizes), len(self.sizes) + len(keys))))
        self.added += keys
        self.ids = np.concatenate((self.ids, ids.astype(np.uint32, copy=False)))
        self.sizes = np.concatenate((self.sizes, sizes.astype(np.int32, copy=False)))

    def _add_pieces(self, pieces: list[str]) -> None:
        alphabet = self.alphabet.__getitem__
        for a in range(0, len(pieces), PIECES):
            part = pieces[a : a + PIECES]
            mapped = " ".join([s if s.isascii() else "".join(map(alphabet, s.encode())) for s in part])
            (coded,) = self.bare.encode_batch_fast([mapped], add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            self._add(part, ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1))

    def _learn(self, new: list[str]) -> None:
        """Number words that have no number, after the pieces they are made of."""
        words = pa.array(new, pa.string())
        piece = pc.match_substring_regex(words, self.PIECE)
        plain = pc.and_not(pc.match_substring_regex(words, self.PLAIN), pc.match_substring(words, "<|"))
        made = _strings(words.filter(pc.and_not(plain, piece)))
        pieces = pa.array(self.split(" ".join(made).lower()), pa.string()).dictionary_encode()
        distinct, index = _strings(pieces.dictionary), pieces.indices.to_numpy()
        known = self.numbers
        fresh = dict.fromkeys(_strings(words.filter(piece)))
        fresh.update(dict.fromkeys([p for p in distinct if p not in known]))
        self._add_pieces(list(fresh))
        if made:
            number = np.array([known[p] for p in distinct], np.int64)[index]
            ids, bounds = self._gather(number)
            sizes = np.diff(np.append(bounds[np.flatnonzero(number == 0)], len(ids)), prepend=0)
            longer = np.array([w not in known for w in made])  # the others are pieces
            self._add([w for w, x in zip(made, longer.tolist()) if x], ids[np.repeat(longer, sizes)], sizes[longer])
        other = _strings(words.filter(pc.invert(plain)))
        if other:
            coded = [self.whole.encode(w, add_special_tokens=False).ids for w in other]
            sizes = np.array([len(x) for x in coded])
            self._add(other, np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum())), sizes)

    def _trim(self, before: int) -> None:
        """Of the numbers given since there were ``before``, keep the first ones there is room for."""
        length = np.fromiter(map(len, self.added), np.int64, len(self.added))
        size = 190 + 2 * length + 4 * self.sizes[before : before + len(length)]  # entry, text and ids, about
        used = np.cumsum(size)
        kept = int(np.searchsorted(used, self.room, "right"))
        self.room -= int(used[kept - 1]) if kept else 0
        for _ in range(len(length) - kept):
            self.numbers.popitem()  # the last one
        self.sizes = self.sizes[: before + kept].copy()
        self.ids = self.ids[: int(self.sizes.sum(dtype=np.int64))].copy()
        self.added = []

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text's ids); every text ends with ``end_id``."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens are case-sensitive
            texts = pc.ascii_lower(texts)
        distinct, index, starts = words(texts)
        listed = _strings(distinct)
        before, known = len(self.sizes), self.numbers
        numbers = np.array([known.get(w, -1) for w in listed], np.int64)
        unknown = np.flatnonzero(numbers < 0)
        new = [listed[i] for i in unknown.tolist()]
        del listed
        if new:
            self._learn(new)
            numbers[unknown] = [known[w] for w in new]
        self._add([], np.array([end_id]), np.array([1]))
        numbers = np.append(numbers, len(self.sizes) - 1)
        index = np.insert(index, starts[1:], len(numbers) - 1)
        ids, bounds = self._gather(numbers[index])
        self._trim(before)
        return ids, bounds[starts + np.arange(len(starts))]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _packed(path: str, key: str, text: str, with_ids: bool, end_id: int, limits: tuple) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << _SEQUENCE_SHIFT
        tokenizer = _tokenizer(path)
        packer = Packer(*limits)

        def out(pieces: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
            keys, starts, ids, n, seq, at = zip(*pieces)
            cols = {
                key: pa.array(keys, key_type),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array([len(x) for x in ids], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                "doc_tokens": pa.array(n, pa.int64()),
                "sequence_id": pa.array([base + s for s in seq], pa.int64()),
                "offset": pa.array(at, pa.int64()),
            }
            if with_ids:
                cols["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(cols)

        kind = None
        try:
            for batch in chunks(batches, text, CHUNK_BYTES):
                kind = batch.column(key).type
                ids, bounds = tokenizer(batch.column(text).fill_null(""), end_id)
                pieces: list[tuple] = []
                for k, a, b in zip(batch.column(key).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    pieces.extend(packer.add(k, ids[a:b]))
                # pieces held over must not keep the whole chunk's ids alive
                packer.items = [(k, s, x.copy(), n) for k, s, x, n in packer.items]
                if pieces:
                    yield out(pieces, kind)
            last = list(packer.flush())
            if last:
                yield out(last, kind)
        finally:
            tokenizer.forget()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    block_windows: int = BLOCK_WINDOWS,
    max_piece: int = MAX_PIECE,
    slack: int = SLACK,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents placed in sequences of at most ``capacity`` ids.

    One row per piece: key, ``start`` (ids of the document before it),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and,
    with ``with_ids``, the ``ids``.  A null or empty text is one end id; null
    and repeated keys are packed row by row; an empty frame gives an empty
    frame.  A long text is cut into whole windows first.  Other columns are
    ignored.
    """
    kind = docs.schema[key].dataType
    fields = [T.StructField(key, kind)] + [
        T.StructField(c, T.LongType())
        for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    limits = (capacity, block_windows, max_piece, slack)
    task = _packed(tokenizer_path, key, text, with_ids, end_id, limits)
    return map_arrow(docs.select(key, text), task, T.StructType(fields))
