"""SimHash near-duplicates by Golay-code fuzzy hashing.

The binary Golay code of length 23 is perfect: every 23-bit word is within
distance 3 of exactly one of its 4,096 codewords.  The codewords nearest to a
word or to a neighbour of it (one bit away) number one or six; two words that
differ in at most two bits have a word between them that is a neighbour of both,
so they share one of these codewords.

1. A text's 64-bit fingerprint has a bit set where over half of its shingle
   hashes have it.  Equal fingerprints are one node from here on.
2. A fingerprint is cut into three segments.  With at most two differing bits one
   segment is equal (pigeonhole) and the next one, cyclically, differs in at most
   two: each segment with each codeword index of the next is a key, at most 18 of
   them.
3. Fingerprints that share a key are compared.  A key with very many of them is
   settled exactly without pairs: all fingerprints within one bit of one 64-bit
   word are linked with each other, so each gives its 65 neighbours as keys, no
   two of which meet in more than 65 fingerprints.
4. Linked fingerprints make components.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.components import connected_components
from graphloom.llm.scratch import materialize
from graphloom.llm.tokens import chunks, lower_ascii, words
from graphloom.operators.joins import lookup_join

SEED = 42
WIDTH = 3  # words of a shingle
ERRORS = 2  # differing bits that link
KEY_ROWS = 512  # fingerprints of one key compared with each other
_TEXT_BYTES = 1 << 20  # text whose shingle bits are counted at once
_SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits), each within the code's 23
_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


# Golay code ---------------------------------------------------------------------------
@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(remainder of the upper 12 bits, error pattern of weight <= 3 by remainder)."""
    upper = np.arange(4096, dtype=np.uint32) << np.uint32(11)
    for bit in range(22, 10, -1):
        upper ^= np.where((upper >> np.uint32(bit)) & 1, np.uint32(_GENERATOR << (bit - 11)), np.uint32(0))
    leader = np.zeros(2048, np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            leader[int(upper[word >> 11]) ^ (word & 2047)] = word
    return upper, leader


def nearest_codeword(words23: np.ndarray) -> np.ndarray:
    """Index (upper 12 bits) of the codeword within distance 3 of each 23-bit word."""
    remainder, leader = _tables()
    w = words23.astype(np.uint32)
    return (w ^ leader[remainder[w >> np.uint32(11)] ^ (w & np.uint32(2047))]) >> np.uint32(11)


def near_indices(segment: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index): the distinct indices of each segment and its neighbours."""
    flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
    index = nearest_codeword((segment.astype(np.uint32)[:, None] ^ flips).ravel()).reshape(-1, len(flips))
    index.sort(axis=1)
    new = np.ones(index.shape, bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    row, at = np.nonzero(new)
    return row, index[row, at]


# fingerprints -------------------------------------------------------------------------
def _digests(distinct: list[bytes], index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, number of shingles of each text)."""
    import xxhash

    h = xxhash.xxh64_intdigest
    out: list[int] = []
    count = np.zeros(len(starts) - 1, np.int64)
    for i, (a, z) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        w = [distinct[k] for k in index[a:z].tolist()]
        if not w:
            continue
        if len(w) < WIDTH:
            out.append(h(b" ".join(w), SEED))
            count[i] = 1
            continue
        out.extend([h(b"%b %b %b" % t, SEED) for t in zip(w, w[1:], w[2:])])
        count[i] = len(w) - WIDTH + 1
    return np.array(out, np.uint64), count


def _majority(digests: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Fingerprints (64-bit) from each text's digests; zero without any."""
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(count)
    step = 1 << 17  # digests unpacked at once
    ends = np.cumsum(count)
    for i in some.tolist() if len(some) and int(count.max()) > step else ():
        ones = np.zeros(64, np.int64)
        for a in range(int(ends[i] - count[i]), int(ends[i]), step):
            part = digests[a : min(a + step, int(ends[i]))]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > count[i], bitorder="little").view(np.uint64)[0]
    if len(some) and int(count.max()) <= step:
        block = ends[some] // step  # texts whose digests are unpacked together
        for texts in np.split(some, np.flatnonzero(np.diff(block)) + 1):
            a, z = int(ends[texts[0]] - count[texts[0]]), int(ends[texts[-1]])
            bits = np.unpackbits(digests[a:z].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, ends[texts] - count[texts] - a, axis=0, dtype=np.int32)
            packed = np.packbits(2 * ones > count[texts][:, None], axis=1, bitorder="little")
            out[texts] = packed.view(np.uint64).ravel()
    return out


def _fingerprint_task(carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, limit=_TEXT_BYTES):
            distinct, index, starts = words(lower_ascii(b.column("text")))
            prints = _majority(*_digests(distinct.cast(pa.binary()).to_pylist(), index, starts))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in carried), pa.array(prints.view(np.int64))], names=[*carried, "fingerprint"]
            )

    return run


def fingerprints(docs: DataFrame, *, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``fingerprint`` (64 bits as a long) of every text."""
    fields = [docs.schema[c] for c in carry] + [T.StructField("fingerprint", T.LongType())]
    return map_arrow(docs.select(*carry, "text"), _fingerprint_task(list(carry)), T.StructType(fields))


# candidates ---------------------------------------------------------------------------
_KEYED = T.StructType([T.StructField("key", T.LongType()), T.StructField("fingerprint", T.LongType())])
_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment with each codeword index of the next, as one long."""
    for b in batches:
        prints = b.column("fingerprint").to_numpy()
        bits = prints.view(np.uint64)
        part = [(bits >> np.uint64(at)) & np.uint64((1 << n) - 1) for at, n in _SEGMENTS]
        for i in range(3):
            j = (i + 1) % 3
            row, index = near_indices(part[j], _SEGMENTS[j][1])
            key = (np.uint64(i) << np.uint64(40)) | (part[i][row] << np.uint64(12)) | index.astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(prints[row])], names=_KEYED.names)


def _spanning(key: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one key (rows sorted by key and fingerprint):
    for every row the nearest earlier ones that keep what is linked connected.

    Rows at growing distance are compared; a row stops at the end of its key."""
    from graphloom.llm.components import stars

    u: list[np.ndarray] = []
    v: list[np.ndarray] = []
    live = np.arange(len(key))
    gap = 0
    bits = prints.view(np.uint64)
    while len(live):
        gap += 1
        live = live[live + gap < len(key)]
        live = live[key[live + gap] == key[live]]
        near = live[np.bitwise_count(bits[live] ^ bits[live + gap]) <= ERRORS]
        u.append(prints[near + gap])
        v.append(prints[near])
        if sum(map(len, u)) > 1 << 18:  # what is linked already is contracted
            a, b = stars(np.concatenate(u), np.concatenate(v))
            u, v = [a], [b]
    return stars(np.concatenate(u), np.concatenate(v)) if u else (prints[:0], prints[:0])


def _compare_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the rows of each key (sorted; at most ``KEY_ROWS`` of one key)."""
    key, prints = np.empty(0, np.int64), np.empty(0, np.int64)

    def linked(k: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        a, b = _spanning(k, p)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=_EDGE.names)

    for batch in batches:
        key = np.concatenate((key, batch.column("key").to_numpy()))
        prints = np.concatenate((prints, batch.column("fingerprint").to_numpy()))
        whole = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on
        if whole:
            yield linked(key[:whole], prints[:whole])
            key, prints = key[whole:], prints[whole:]
    if len(key):
        yield linked(key, prints)


def _neighbour_links(prints: DataFrame) -> DataFrame:
    """Links among ``prints`` without comparing pairs: everything within one bit of
    one word (65 fingerprints at most) is linked."""
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    near = prints.select("fingerprint", F.explode(flips).alias("flip")).select(
        F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("word"), "fingerprint"
    )
    balls = near.groupBy("word").agg(F.collect_list("fingerprint").alias("all")).where(F.size("all") > 1)
    return balls.select(F.array_min("all").alias("b"), F.explode("all").alias("a")).where("a <> b").select("a", "b")


def links(prints: DataFrame, *, key_rows: int = KEY_ROWS) -> DataFrame:
    """(``a``, ``b``): edges that connect all of the distinct ``prints``
    (``fingerprint``) that differ in at most two bits, directly or through each other."""
    keyed = materialize(map_arrow(prints, _key_task, _KEYED), "golay-keys")
    shared = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "golay-shared")
    met = lookup_join(keyed, shared, "key", "key")
    few = met.where(F.col("n") <= key_rows).select("key", "fingerprint")
    compared = map_arrow(few.repartition("key").sortWithinPartitions("key", "fingerprint"), _compare_task, _EDGE)
    if shared.where(F.col("n") > key_rows).isEmpty():
        return compared
    many = met.where(F.col("n") > key_rows).select("fingerprint").distinct()
    return compared.unionByName(_neighbour_links(many).select("a", "b"))


def simhash_groups(docs: DataFrame, *, carry: tuple[str, ...] = ("doc_id",), key_rows: int = KEY_ROWS) -> DataFrame:
    """Near-duplicate groups by SimHash.

    One row per document: ``carry`` (with ``doc_id``), ``fingerprint`` (16
    lower-case hexadecimal digits), ``component_id`` (the smallest ``doc_id``
    reachable over links of at most two differing bits) and ``n_linked``
    (different fingerprints in the component).

    A null or empty text, or one without words, has fingerprint zero and is
    linked like any other; a text of fewer than three words is one shingle;
    repeated rows are rows of their own; null ids are reached but never the
    smallest (null where a component has no other); an empty table gives no
    rows; other columns are ignored.  Texts are read whole, a chunk at a time.
    """
    printed = materialize(fingerprints(docs, carry=carry), "simhash")
    nodes = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("low"))
    nodes = materialize(nodes, "simhash-nodes")
    roots = connected_components(links(nodes.select("fingerprint"), key_rows=key_rows))
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "fingerprint")), "simhash-rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n_linked"))
    named = lookup_join(rooted.select("fingerprint", "root"), lowest, "root", "root").drop("root")
    out = lookup_join(printed, named, "fingerprint", "fingerprint")
    return out.select(*carry, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id", "n_linked")
