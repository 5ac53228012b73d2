"""Language-model scoring with a sharded Elias-Fano n-gram trie.

Documents are cut into blocks.  A block sends the distinct n-grams of its
tokens, with their training counts, to the shards of their contexts; a shard
merges what all blocks sent, builds its part of each trie level, answers every
block's n-grams from it, and the block adds up its documents' scores.  Neither
the corpus nor the model is ever in one place, and a frequent n-gram is sent
once per block.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import groups, map_arrow
from graphloom.llm.ngram_trie import Level, build, probability
from graphloom.llm.scratch import materialize, table
from graphloom.llm.tokens import chunks, hash_strings, lower_ascii, mix64, words

ORDER = 3
BLOCK_BYTES = 12 << 20  # text of a block
SHARD_BYTES = 16 << 20  # text per shard
SUCCESSOR_BITS = {2: 32, 3: 24}  # the rest of a 64-bit key tells a shard's contexts apart
_END = np.uint64(0x6A09E667F3BCC909)
_START = np.uint64(0xBB67AE8584CAA73B)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Compressed unsigned integers: byte planes of the values or their steps."""
    import zstandard

    x = values.astype("<u8")
    if rising:
        x = np.diff(x, prepend=np.uint64(0))
    planes = x.view(np.uint8).reshape(-1, 8).T
    used = int(np.flatnonzero(planes.any(1)).max(initial=-1)) + 1
    head = np.array([len(x), used], "<u4").tobytes()
    return head + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:used]).tobytes())


def unpack(data: bytes, rising: bool = False) -> np.ndarray:
    import zstandard

    n, used = np.frombuffer(data, "<u4", 2).tolist()
    planes = np.zeros((n, 8), np.uint8)
    if n and used:
        raw = zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=n * used)
        planes[:, :used] = np.frombuffer(raw, np.uint8).reshape(used, n).T
    x = planes.view("<u8").ravel()
    return np.cumsum(x, dtype=np.uint64) if rising else x


_BLOCK = [
    T.StructField("held", T.ArrayType(T.BooleanType())),
    T.StructField("lengths", T.BinaryType()),
    T.StructField("tokens", T.BinaryType()),
    T.StructField("hashes", T.BinaryType()),
]


def _blocks_task(names: list[str]):
    """Token blocks: distinct word hashes, and each document's indices into them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for b in chunks(_joined(batches), limit=BLOCK_BYTES):
            distinct, index, starts = words(lower_ascii(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([b.column("doc_id").to_pylist()], pa.list_(b.column("doc_id").type)),
                 pa.array([b.column("held").to_pylist()], pa.list_(pa.bool_())),
                 pa.array([pack(np.diff(starts))], pa.binary()), pa.array([pack(index)], pa.binary()),
                 pa.array([hash_strings(distinct).tobytes()], pa.binary())],
                names=names,
            )
            block += 1

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about a block's text, so that small ones share a block."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held and sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class _Tokens:
    """A block's tokens (with ends) and its distinct n-grams by level."""

    def __init__(self, row: dict):
        lengths = unpack(row["lengths"]).astype(np.int64)
        word = np.append(np.frombuffer(row["hashes"], np.uint64), _END)
        index = np.insert(unpack(row["tokens"]).astype(np.int64), np.cumsum(lengths), len(word) - 1)
        self.lengths = lengths + 1
        self.doc = np.repeat(np.arange(len(lengths)), self.lengths)
        self.train = ~np.array(row["held"], bool)[self.doc]
        self.index, self.word = index, word

    def level(self, n: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct keys, their shards, their training counts, key of every
        token), keys ordered by shard, then value."""
        if n == 1:
            # a word's own hash is its key: the shard only spreads the load
            key, inverse = self.word, self.index
            place, _ = _place(mix64(key), shards)
            order = np.lexsort((key, place))
            order = order[np.bincount(inverse, minlength=len(key))[order] > 0]
        else:
            w = self.word[self.index]
            first = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64)
            context = np.zeros(len(w), np.uint64)
            for back in range(1, n):
                past = np.concatenate((np.full(back, _START), w[:-back]))[: len(w)]
                for k in range(back):  # before a document's start
                    at = first + k
                    past[at[k < self.lengths]] = _START
                context = mix64(context + past * np.uint64(0x9E3779B97F4A7C15 + 2 * back))
            place, inside = _place(context, shards)
            bits = np.uint64(SUCCESSOR_BITS[n])
            keys = (inside >> bits << bits) | (mix64(w) >> (np.uint64(64) - bits))
            key, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
            place = place[at]
            order = np.argsort(place, kind="stable")
        back = np.empty(len(key), np.int64)
        back[order] = np.arange(len(order))
        of_token = back[inverse]
        counts = np.bincount(of_token[self.train], minlength=len(order)).astype(np.int64)
        return key[order], place[order], counts, of_token


def _place(h: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, position inside the shard) of 64-bit hashes: the high and low
    halves of the 128-bit product h * shards."""
    s, half = np.uint64(shards), np.uint64(32)
    p = (h & np.uint64(0xFFFFFFFF)) * s
    q = (h >> half) * s + (p >> half)
    return (q >> half).astype(np.int64), (q << half) | (p & np.uint64(0xFFFFFFFF))


_SENT = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("level", T.IntegerType()),
     T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())]
)
_ANSWER = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("level", T.IntegerType()),
     T.StructField("payload", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("v", T.LongType())]
)


def _send_task(levels: tuple[int, ...], shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                tokens = _Tokens(row)
                for n in levels:
                    key, place, counts, _ = tokens.level(n, shards)
                    cuts = np.flatnonzero(np.diff(place)) + 1
                    rows = [
                        (int(place[a]), pack(key[a:z], rising=True), pack(counts[a:z]))
                        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)])
                        if z > a
                    ]
                    if rows:
                        shard, keys, sent = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["block"]] * len(rows), pa.int64()), pa.array(shard, pa.int32()),
                             pa.array([n] * len(rows), pa.int32()), pa.array(keys, pa.binary()), pa.array(sent, pa.binary())],
                            names=_SENT.names,
                        )

    return run


def _answer_task():
    """Merge a shard's n-grams of one level, build its trie part, answer every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["shard", "level"]):
            level, shard = t["level"][0].as_py(), t["shard"][0].as_py()
            keys = [unpack(k, rising=True) for k in t["keys"].to_pylist()]
            counts = np.concatenate([unpack(c) for c in t["counts"].to_pylist()]).astype(np.float64)
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, weights=counts, minlength=len(key)).astype(np.int64)
            ends = np.cumsum([len(k) for k in keys])
            blocks = t["block"].to_pylist()
            seen = total > 0
            if level == 1:
                payload = [pack(total[inverse[e - len(k) : e]]) for k, e in zip(keys, ends.tolist())]
                blocks.append(-1)
                payload.append(b"")
            else:
                bits = SUCCESSOR_BITS[level]
                trie = Level(build(key[seen], total[seen], bits), bits)
                direct, backoff = trie.query(key)
                payload = []
                for k, e in zip(keys, ends.tolist()):
                    at = inverse[e - len(k) : e]
                    payload.append(pack(direct[at].astype(np.uint64) | (backoff[at].astype(np.uint64) << np.uint64(8))))
            totals = [0] * (len(blocks) - (level == 1)) + [int(total.sum())] * (level == 1)
            distinct = [0] * (len(blocks) - (level == 1)) + [int(seen.sum())] * (level == 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array([shard] * len(blocks), pa.int32()), pa.array([level] * len(blocks), pa.int32()),
                 pa.array(payload, pa.binary()), pa.array(totals, pa.int64()), pa.array(distinct, pa.int64())],
                names=_ANSWER.names,
            )

    return run


def _score_block(order: int, shards: int, n: int, v: int, names: list[str]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        key_type = left.schema.field("doc_ids").type.value_type
        for row in left.to_pylist():
            tokens = _Tokens(row)
            answers = {k: [] for k in range(1, order + 1)}
            for a in sorted(right.select(["level", "shard", "payload"]).to_pylist(), key=lambda a: (a["level"], a["shard"])):
                answers[a["level"]].append(unpack(a["payload"]))
            at = {k: tokens.level(k, shards)[3] for k in answers}
            got = {k: np.concatenate([*answers[k], np.empty(0, np.uint64)]) for k in answers}
            count = got[1][at[1]].astype(np.float64)
            base = (count + 0.1) / (n + 0.1 * (v + 1))
            p = base
            for k in range(2, order + 1):
                code = got[k][at[k]]
                p = probability((code & np.uint64(255)).astype(np.int64)) + probability((code >> np.uint64(8)).astype(np.int64)) * p
            docs = len(tokens.lengths)
            out.append(pa.Table.from_arrays(
                [pa.array(row["doc_ids"], key_type), pa.array(row["held"], pa.bool_()), pa.array(tokens.lengths, pa.int64()),
                 pa.array(np.bincount(tokens.doc, weights=count > 0, minlength=docs).astype(np.int64), pa.int64()),
                 pa.array([n] * docs, pa.int64()),
                 pa.array(np.bincount(tokens.doc, weights=np.log10(base), minlength=docs), pa.float64()),
                 pa.array(np.bincount(tokens.doc, weights=np.log10(p), minlength=docs), pa.float64())],
                names=names,
            ))
        return pa.concat_tables(out)

    return run


def score_documents(docs: DataFrame, held_out: Column, *, order: int = ORDER) -> DataFrame:
    """Log10 probabilities of whole texts under an n-gram model of the rows that
    are not held out.

    Per row: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (add-0.1 unigrams) and ``score`` (Witten-Bell n-grams over those unigrams).
    A null ``held_out`` counts as true; a null or empty text is one end; rows
    are independent of their ids, repeated rows are counted each; other columns
    are ignored; an empty frame gives an empty frame.  Words are told apart by
    64-bit hashes, n-grams inside a shard by 64 bits, so an unseen n-gram is
    taken for a seen one with a chance of (successors of its context) / 2**24
    at most (2**32 for bigrams).
    """
    spark = docs.sparkSession
    text = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(True)).alias("held"))
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // SHARD_BYTES))
    key = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(key.dataType)), *_BLOCK])
    # bucketed by block, so the last step meets the answers without moving the tokens
    blocks = table(map_arrow(text, _blocks_task(schema.names), schema), "lm-blocks", "block", shards)

    def answers(levels: tuple[int, ...]) -> DataFrame:
        sent = map_arrow(blocks, _send_task(levels, shards), _SENT)
        dealt = sent.repartition(shards, "shard", "level").sortWithinPartitions("shard", "level", "block")
        return map_arrow(dealt, _answer_task(), _ANSWER)

    words_seen = materialize(answers((1,)), "lm-words")
    row = words_seen.where("block = -1").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = int(row["n"] or 0), int(row["v"] or 0)
    every = words_seen.where("block >= 0").select("block", "level", "shard", "payload")
    if order > 1:
        every = every.unionByName(answers(tuple(range(2, order + 1))).select("block", "level", "shard", "payload"))
    out = T.StructType(
        [key, T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
         T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
         T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    )
    task = _score_block(order, shards, n, v, out.names)
    return blocks.groupBy("block").cogroup(every.groupBy("block")).applyInArrow(task, out)
