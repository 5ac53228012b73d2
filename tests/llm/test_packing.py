import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from graphloom.llm import packing
from graphloom.llm.packing import differencing, pack_documents, partition

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_differencing_sums_and_balance():
    rng = random.Random(1)
    sizes = [rng.randint(1, 256) for _ in range(700)]
    place, sums = differencing(sizes, 64)
    assert np.array_equal(np.bincount(place, weights=sizes, minlength=64).astype(int), sums)
    assert sums.max() - sums.min() <= 4
    assert differencing([5], 1)[0].tolist() == [0]
    # eight items, two sets: the classic example splits 8,7,6,5,4 as 16 and 14
    assert sorted(differencing([8, 7, 6, 5, 4], 2)[1].tolist()) == [14, 16]


def test_window_count_rises_with_capacity():
    place, windows = partition([6, 6, 6], 10)  # two windows would hold 18 ids, but not these pieces
    assert windows == 3 and sorted(place.tolist()) == [0, 1, 2]
    assert partition([10, 10], 10)[1] == 2 and partition([], 10)[1] == 1


def test_pieces_rebuild_every_document(spark):
    rng = random.Random(2)
    words = ["the", "Don't", "naïve", "ÀÉÎ", "日本語", "x" * 300, "<|endoftext|>", "<|STARTOFTEXT|>", "3.14", "a b", "İ", "''s", "Σας"]
    texts = [None, "", " \n", "word " * 30_000] + [" ".join(rng.choice(words) for _ in range(rng.randint(0, 900))) for _ in range(150)]
    rows = [(i % 140 if i != 9 else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    out = pack_documents(docs, PATH).collect()
    whole = Tokenizer.from_file(PATH)
    want = sorted(whole.encode(t or "", add_special_tokens=False).ids + [1] for t in texts)
    # rows of one document have its length; equal (id, start) of repeated ids are told apart by sequence order
    sequences = {}
    for r in out:
        assert 0 < r.length <= 2048 and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in out) == sum(map(len, want))
    unique = {k for k in {r[0] for r in rows} if sum(r[0] == k for r in rows) == 1}
    by = {}
    for r in out:
        if r.doc_id in unique:
            by.setdefault(r.doc_id, []).append(r)
    for k, pieces in by.items():
        text = next(t for i, t, _ in rows if i == k)
        ids = []
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == len(ids)
            ids += p.ids
        assert ids == whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert all(p.doc_tokens == len(ids) for p in pieces)


def test_little_padding_and_empty(spark):
    docs = spark.range(0, 3000, numPartitions=2).selectExpr("id as doc_id", "repeat('lorem ipsum ', cast(id % 700 as int)) as text")
    out = pack_documents(docs, PATH, with_ids=False)
    assert "ids" not in out.columns
    tokens, sequences = out.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert tokens / (2048 * sequences) > 0.985
    assert pack_documents(docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("capacity", [1, 7])
def test_tiny_capacity(spark, capacity):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, None)], "doc_id long, text string")
    out = pack_documents(docs, PATH, capacity=capacity, slack=0, max_piece=3).collect()
    assert sum(r.length for r in out) == 12 and max(r.length for r in out) <= capacity


@pytest.mark.parametrize("room", [0, 20_000, 80 << 20])
def test_words_are_encoded_many_at_a_time(monkeypatch, room):
    """Plain words reach the model in a few calls, and ids do not depend on what is remembered."""
    monkeypatch.setattr(packing, "CACHE_BYTES", room)
    tokenizer = packing.WordTokenizer(PATH)
    calls = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return bare.encode_batch_fast(texts, **options)

    bare, tokenizer.bare = tokenizer.bare, Counted()
    rng = random.Random(5)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(1, n)))
    plain = [some("abcdefgXYZéÉßœŒ", 9) + some("'s.,!#7&-", 4) for _ in range(20_000)]
    odd = ["日本語", "İx", "ŉ", "<|endoftext|>", "a<|b", "é", "\x01\x02", "x\xa0y", " ", "''s", "don't", "THE", "the", "é", "É"]
    texts = [" ".join(rng.choices(plain, k=700) + rng.choices(odd, k=9)) for _ in range(40)]
    texts += ["", " \n", *odd, " ".join(plain)]
    rng.shuffle(texts)
    for part in (texts[:20], texts[20:30], texts[30:], texts):
        calls.clear()
        ids, bounds = tokenizer(pa.array(part), 1)
        assert len(calls) <= 4 and bounds[0] == 0 and bounds[-1] == len(ids)
        for t, a, b in zip(part, bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == tokenizer.whole.encode(t, add_special_tokens=False).ids + [1]
        assert tokenizer.room >= 0 and len(tokenizer.numbers) == len(tokenizer.sizes)
    assert (room > 20_000) == (len(tokenizer.numbers) > 10_000)
    tokenizer.forget()
    assert len(tokenizer.numbers) == 1 and tokenizer.room == room
