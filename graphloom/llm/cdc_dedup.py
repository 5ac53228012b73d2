"""Substring dedup by content-defined chunking with a gear rolling hash.

A text is cut where the gear hash of the last bytes is smaller than at every
position around it, so cuts depend only on nearby bytes and an insertion moves
no cut beyond its neighbourhood.  Chunks are compared by digest over all
documents; a run of chunks that an earlier document already has is the seed of a
repeated passage, which goes on as far as the bytes agree on both sides.  Only
its first document keeps it.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.scratch import materialize, row_keyed
from graphloom.llm.tokens import chunks, mix64

RADIUS = 16  # a cut is the smallest hash within this many bytes on both sides
WINDOW = 16  # bytes the gear hash remembers (32 bits, two shifted out per byte)
MIN_WORDS = 25  # words of matching bytes that make a repeated passage
_PAD = WINDOW + RADIUS
REACH = 96  # bytes beside a seed that are compared first; where all agree, the whole rest is
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_BYTE = mix64(np.arange(1001, 1257, dtype=np.uint64)) | np.uint64(1)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i-1] << 2) + GEAR[data[i]] in 32 bits, for all i at once by doubling."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step].copy() << np.uint32(2 * step)
        step *= 2
    return h


def _cuts(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes a chunk ends after."""
    h = gear_hash(data)
    low = h
    step = 1
    while step < RADIUS:  # low[i] = smallest hash in [i, i + RADIUS)
        low = np.minimum(low, np.concatenate((low[step:], np.full(step, 0xFFFFFFFF, np.uint32))))
        step *= 2
    before = np.concatenate((np.full(RADIUS, 0xFFFFFFFF, np.uint32), low[:-RADIUS]))[: len(h)]
    after = np.concatenate((low[1:], [np.uint32(0xFFFFFFFF)]))
    whole = np.concatenate(((data[1:] & 0xC0) != 0x80, [True]))  # never inside a UTF-8 character
    return (h < before) & (h <= after) & whole


def chunk_texts(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(text, chunk number, first byte, length, words started, digest) of every chunk."""
    binary = pc.fill_null(texts, "").cast(pa.large_binary())
    sizes = pc.binary_length(binary).to_numpy(zero_copy_only=False).astype(np.int64)
    total = int(sizes.sum())
    raw = np.frombuffer(b"".join(binary.to_pylist()), np.uint8)
    n = len(sizes)
    row = np.repeat(np.arange(n), sizes)
    # padding between texts: cuts near a text's start depend on that text alone
    data = np.zeros(total + _PAD * (n + 1), np.uint8)
    place = np.arange(total) + _PAD * (row + 1)
    data[place] = raw
    cut = _cuts(data)[place]
    last = np.cumsum(sizes)[sizes > 0] - 1
    cut[last] = True
    end = np.flatnonzero(cut)
    begin = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
    length = end - begin + 1
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    prior = np.concatenate(([True], space[:-1])) if total else space
    prior[np.cumsum(sizes)[:-1][np.cumsum(sizes)[:-1] < total]] = True
    starts = (~space) & prior
    at = np.arange(total) - np.repeat(begin, length)
    weight = mix64(np.arange(1, int(length.max(initial=0)) + 1, dtype=np.uint64)) | np.uint64(1)
    parts = _BYTE[raw] * weight[at]
    digest = np.add.reduceat(parts, begin) if len(begin) else np.empty(0, np.uint64)
    digest = mix64(digest + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    words = np.add.reduceat(starts.astype(np.int64), begin) if len(begin) else begin
    text = row[begin] if total else begin
    first_chunk = np.searchsorted(text, text)
    offset = np.concatenate(([0], np.cumsum(sizes)))
    return text, np.arange(len(text)) - first_chunk, begin - offset[text], length, words, digest.view(np.int64)


def chunk_documents(docs: DataFrame) -> DataFrame:
    """One row per chunk of each text: ``row``, ``doc_id``, ``start``, ``length``
    (bytes), ``digest``.  Empty and null texts have none."""
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(c, T.IntegerType()) for c in ("start", "length")]
        + [T.StructField("digest", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            text, _, *ints, _, digest = chunk_texts(b.column("text"))
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(at), b.column("doc_id").take(at), *(pa.array(x.astype(np.int32)) for x in ints), pa.array(digest)],
                names=schema.names,
            )

    return map_arrow(docs.select("row", "doc_id", "text"), run, schema)


_ENDS = T.StructType(
    [T.StructField("run", T.LongType()), T.StructField("left", T.BooleanType()), T.StructField("bytes", T.LongType())]
)


def common_end(mine: bytes, other: bytes, left: bool) -> int:
    """Bytes on which two texts agree beside a seed: the ends of what comes before
    it, or the starts of what comes after it; never a part of a UTF-8 character."""
    raw = np.frombuffer(mine, np.uint8)
    a, b = (raw[::-1], np.frombuffer(other, np.uint8)[::-1]) if left else (raw, np.frombuffer(other, np.uint8))
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    n = int(differ[0]) if len(differ) else n
    cut = len(raw) - n if left else n
    while n and cut < len(raw) and raw[cut] & 0xC0 == 0x80:
        n, cut = n - 1, cut + 1 if left else cut - 1
    return n


def _ends_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        left = b.column("left").to_pylist()
        ends = [common_end(m.as_py(), o.as_py(), s) for m, o, s in zip(b.column("mine"), b.column("other"), left)]
        yield pa.RecordBatch.from_arrays([b.column("run"), b.column("left"), pa.array(ends, pa.int64())], names=_ENDS.names)


def words_started(text: bytes, start: int, length: int) -> int:
    """Words that start in a span of a text."""
    raw = np.frombuffer(text, np.uint8)[max(start - 1, 0) : start + length]
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    starts = ~space & np.concatenate(([True], space[:-1]))
    return int(starts[1 if start else 0 :].sum())


def _words_task(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = [t.as_buffer() for t in b.column("text").cast(pa.large_binary())]
            spans = zip(texts, b.column("start").to_pylist(), b.column("length").to_pylist())
            n = pa.array([words_started(*s) for s in spans], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:-1]), n], names=names)

    return run


def _ends(asks: DataFrame, texts: DataFrame, reach: int | None) -> DataFrame:
    """How far the bytes agree on each asked side of a run, within ``reach`` bytes;
    runs whose own bytes differ from the first document's (equal digests of
    different chunks) are left out."""
    data, at = F.col("text").cast("binary"), F.col("at").cast("int")
    size, length = F.octet_length(data), F.col("length").cast("int")
    first = F.greatest(at - reach, F.lit(0)) if reach else F.lit(0)
    after = F.substring(data, at + length + 1, F.lit(reach) if reach else size)
    piece = F.when(F.col("left"), F.substring(data, first + 1, at - first)).otherwise(after)
    seed = F.md5(F.substring(data, at + 1, length))
    pieces = asks.join(texts, "row").select("run", "left", "own", piece.alias("piece"), seed.alias("seed"))
    mine = pieces.where("own").select("run", "left", "seed", F.col("piece").alias("mine"))
    other = pieces.where("not own").select("run", "left", "seed", F.col("piece").alias("other"))
    return map_arrow(mine.join(other, ["run", "left", "seed"]).drop("seed"), _ends_task, _ENDS)


def _asked(runs: DataFrame, sides: Column) -> DataFrame:
    """Both texts of every run on the asked sides (``sides``: array of "is left")."""

    def place(own: bool, row: str, at: Column) -> Column:
        return F.struct(F.lit(own).alias("own"), F.col(row).alias("row"), at.alias("at"))

    places = F.array(place(True, "row", F.col("start")), place(False, "first_row", F.col("start") - F.col("shift")))
    each = runs.select("*", F.explode(sides).alias("left"))
    return each.select("run", "length", "left", F.explode(places).alias("place")).select("run", "length", "left", "place.*")


def _per_run(ends: DataFrame) -> DataFrame:
    side = lambda left: F.max(F.when(F.col("left") == left, F.col("bytes")))
    return ends.groupBy("run").agg(side(True).alias("before"), side(False).alias("behind"))


def _extended(runs: DataFrame, texts: DataFrame) -> DataFrame:
    """``runs`` with their ends moved as far as the bytes agree with the first
    document; runs that become one and the same passage are one row."""
    both = F.array(F.lit(True), F.lit(False))
    ends = _per_run(_ends(_asked(runs, both), texts, REACH))
    far = F.lit(REACH - 4)  # a cut character may have been left out
    grown = runs.join(ends, "run").select(
        "row", "first_row", "shift", "doc_id", "first_doc_id", "n_chunks",
        (F.col("start") - F.col("before")).alias("start"),
        (F.col("start") + F.col("length") + F.col("behind")).alias("end"),
        (F.col("before") > far).alias("more_before"),
        (F.col("behind") > far).alias("more_behind"),
    )
    # what agrees on both sides of a chunk that occurs elsewhere first is one run again
    here = Window.partitionBy("row", "first_row", "shift").orderBy("start", "end")
    reach = F.max("end").over(here.rowsBetween(Window.unboundedPreceding, -1))
    parted = grown.withColumn("new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    parted = parted.withColumn("piece", F.sum("new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    joined = parted.groupBy("row", "first_row", "shift", "piece").agg(
        F.first("doc_id").alias("doc_id"), F.first("first_doc_id").alias("first_doc_id"), F.sum("n_chunks").alias("n_chunks"),
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.min(F.struct("start", ~F.col("more_before")))["col2"].alias("whole_before"),
        F.max(F.struct("end", ~F.col("more_behind")))["col2"].alias("whole_behind"),
    )
    merged = joined.withColumn("run", F.monotonically_increasing_id()).withColumn("length", F.col("end") - F.col("start"))
    merged = materialize(merged, "merged-runs")
    open_ = F.array_compact(F.array(F.when(~F.col("whole_before"), True), F.when(~F.col("whole_behind"), False)))
    rest = materialize(_per_run(_ends(_asked(merged.where("not whole_before or not whole_behind"), open_), texts, None)), "far-ends")
    none = F.lit(0).cast("long")
    out = merged.join(rest, "run", "left").select(
        "row", "doc_id", F.struct("first_doc_id", "first_row").alias("first"), "n_chunks",
        (F.col("start") - F.coalesce("before", none)).alias("start"),
        (F.col("length") + F.coalesce("before", none) + F.coalesce("behind", none)).alias("length"),
    )
    one = out.groupBy("row", "start", "length").agg(F.first("doc_id").alias("doc_id"), F.sum("n_chunks").alias("n_chunks"), F.min("first").alias("first"))
    return one.withColumn("first_doc_id", F.col("first.first_doc_id")).drop("first")


def repeated_spans(docs: DataFrame, *, row: str | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that an earlier document (smaller id) already has.

    One row per passage: ``row``, ``doc_id``, ``start`` and ``length`` in bytes
    of the UTF-8 text, ``n_chunks``, ``n_words``, ``first_doc_id`` (where its
    first chunk occurs first).  A passage is a run of neighbouring chunks that
    stand in the same order in one earlier document, and what agrees byte by byte
    before and after it there: that document has the whole passage, byte for byte.
    It starts at least ``min_words`` words.  Passages of one text may overlap.
    Rows are told apart by place (or by the unique column ``row``), so equal
    rows repeat each other; null ids come first; null, empty and unrepeated
    texts give no row; other columns are ignored.
    """
    if row:
        named = docs.select(F.col(row).alias("row"), "doc_id", "text")
    else:  # the texts are read again for the ends, by the same row ids
        keyed, by = row_keyed(docs.select("doc_id", "text"), "cdc-input")
        named = keyed.select((F.col(by[0]) if len(by) == 1 else F.xxhash64(*by)).alias("row"), "doc_id", "text")
    found = materialize(chunk_documents(named), "chunks")
    # digests of several rows first, by two numbers each (a hash aggregate); only
    # their chunks are looked at further
    several = found.groupBy("digest").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo <> hi").select("digest")
    shared = materialize(found.join(several, "digest"), "shared-chunks")
    repeated = (
        shared.groupBy("digest").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"))
        .select("digest", F.col("first.row").alias("first_row"), F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("at"))
    )
    later = shared.join(repeated, "digest").where(F.col("row") != F.col("first_row"))
    # a run goes on while its chunks follow each other here and in one first document:
    # then start less the bytes of the chunks before it stays the same
    along = Window.partitionBy("row", "first_row", "shift").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    runs = later.withColumn("shift", F.col("start") - F.col("at"))
    runs = runs.withColumn("island", F.col("start") - F.coalesce(F.sum("length").over(along), F.lit(0)))
    runs = (
        runs.groupBy("row", "first_row", "shift", "island")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("first_doc_id").alias("first_doc_id"),
            F.min("start").cast("long").alias("start"),
            F.sum("length").cast("long").alias("length"),
            F.count(F.lit(1)).alias("n_chunks"),
        )
        .drop("island")
    )
    runs = materialize(runs.withColumn("run", F.monotonically_increasing_id()), "runs")
    texts = named.select("row", "text")
    spans = materialize(_extended(runs, texts).where(F.col("length") >= 2 * min_words - 1), "spans")  # shorter ones cannot hold the words
    names = ["row", "doc_id", "start", "length", "n_chunks", "first_doc_id", "n_words"]
    schema = T.StructType([spans.schema[c] for c in names[:-1]] + [T.StructField("n_words", T.LongType())])
    counted = map_arrow(spans.join(texts, "row").select(*names[:-1], "text"), _words_task(names), schema)
    return counted.where(F.col("n_words") >= min_words)


def dedup_documents(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut out of all but its first document.

    Rows without a repeated passage, null and empty texts are unchanged; a row equal
    to an earlier one is left empty; an empty frame gives an empty frame.  An input
    column named ``row`` is kept apart and returned.
    """
    base = materialize(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "dedup-input")
    spans = repeated_spans(base.select("_llm_row", "doc_id", "text"), row="_llm_row", min_words=min_words)
    cuts = spans.groupBy(F.col("row").alias("_llm_row")).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_llm_cuts"))
    data = F.col("text").cast("binary")
    kept = F.aggregate(
        "_llm_cuts",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").cast("binary").alias("out")),
        lambda acc, c: F.struct(
            F.greatest(acc["at"], c["start"] + c["length"]).alias("at"),  # ends of passages may overlap
            F.concat(acc["out"], F.substring(data, (acc["at"] + 1).cast("int"), F.greatest(c["start"] - acc["at"], F.lit(0)).cast("int"))).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(data, (acc["at"] + 1).cast("int"), F.octet_length(data))).cast("string"),
    )
    text = F.when(F.col("_llm_cuts").isNull(), F.col("text")).otherwise(kept)
    return base.join(cuts, "_llm_row", "left").withColumn("text", text).drop("_llm_row", "_llm_cuts")
