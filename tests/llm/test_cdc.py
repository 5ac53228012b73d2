import random
import re

import numpy as np
import pyarrow as pa

from graphloom.llm.cdc_dedup import chunk_texts, common_end, dedup_documents, gear_hash, repeated_spans, words_started
from graphloom.llm.queries import QUERIES
from tests.conftest import SMALL


def text(rng, n):
    return " ".join(rng.choice("the of and in a river stone lamp city walks green seven morning quick".split()) + str(rng.randrange(10**5)) for _ in range(n))


def test_gear_hash_is_rolling():
    data = np.random.default_rng(1).integers(0, 256, 300, np.uint8)
    from graphloom.llm.cdc_dedup import _GEAR

    h, rolled = np.uint64(0), []
    for b in data.tolist():
        h = ((h << np.uint64(2)) + np.uint64(_GEAR[b])) & np.uint64(0xFFFFFFFF)
        rolled.append(int(h))
    assert gear_hash(data).tolist() == rolled


def test_chunks_cover_texts_and_resist_insertions():
    rng = random.Random(1)
    a = text(rng, 400) + " é日本語 " + text(rng, 20)
    b = a[:900] + "INSERTED" + a[900:]
    rows = ["", a, None, "x" * 5000, b, "é"]
    row, seq, start, length, words, digest = chunk_texts(pa.array(rows))
    for i, t in enumerate(rows):
        raw = (t or "").encode()
        at = 0
        for s, n in zip(start[row == i], length[row == i]):
            assert s == at
            raw[s : s + n].decode()  # never inside a character
            at += n
        assert at == len(raw) and seq[row == i].tolist() == list(range((row == i).sum()))
        assert words[row == i].sum() == len((t or "").split())
    mine, other = digest[row == 1], digest[row == 4]
    assert len(set(other.tolist()) - set(mine.tolist())) <= 4


def test_repeated_passages_are_found_and_cut(spark):
    rng = random.Random(4)
    passages = [text(rng, 55) for _ in range(5)]
    rows = [(i, text(rng, 80)) for i in range(40)]
    for k, p in enumerate(passages):
        for i in range(3):
            rows.append((100 + 10 * i + k, f"{text(rng, 30)} {p}\n{text(rng, 40 - i)}"))
    copy = text(rng, 90)
    rows += [(200, copy), (201, copy), (201, copy), (300, None), (301, ""), (None, copy), (302, passages[0] + "é" * 3)]
    rows += [(400, "stock phrase that many texts share, some twelve words and no more of it " + text(rng, 30)) for _ in range(2)]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, seq int, digest string").repartition(4)
    spans = repeated_spans(docs).collect()
    hit = {r.doc_id for r in spans}
    assert hit == {100 + 10 * i + k for i in (1, 2) for k in range(5)} | {200, 201, 302}  # the null id comes first
    for r in spans:
        source = [t for i, t in rows if i == r.first_doc_id and t]
        piece = [t.encode()[r.start : r.start + r.length] for i, t in rows if i == r.doc_id]
        assert any(p and any(p in s.encode() for s in source) for p in piece)
        assert r.n_words >= 25 and r.first_doc_id != r.doc_id or r.doc_id == 201
    cut = sorted(dedup_documents(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert len(cut) == len(rows) and set(cut[0].asDict()) == {"doc_id", "text", "seq", "digest"}
    kept = {r.doc_id: r.text for r in cut}
    assert kept[0] == rows[0][1] and kept[300] is None and kept[301] == "" and kept[None] == copy
    assert len(kept[200]) < 120 and len(kept[110]) < len(dict(rows)[110]) - 150
    assert repeated_spans(docs.limit(0)).collect() == []


def test_common_end_keeps_characters():
    assert common_end(b"xx one two ", b"yy one two ", True) == 9
    assert common_end(b" three fo", b" three fi", False) == 8
    assert common_end("aé".encode(), "a\u0129".encode(), True) == 0  # the last byte alone agrees
    assert common_end("aé".encode(), "aè".encode(), False) == 1
    assert common_end(b"", b"abc", True) == 0 and common_end(b"", b"", False) == 0


def test_words_started():
    text = "one two  thrée".encode()
    assert [words_started(text, *s) for s in [(0, 15), (1, 14), (3, 5), (4, 3), (0, 0)]] == [3, 2, 1, 1, 0]


def test_passages_of_short_words_are_found_whole(spark):
    rng = random.Random(9)
    numbers = lambda n: " ".join(str(rng.randrange(100)) for _ in range(n))
    rows, passages = [], []
    for k in range(60):
        passages.append(numbers(51))
        rows += [(k, f"{text(rng, 20)} {passages[k]} {text(rng, 20)}"), (100 + k, f"{text(rng, 20)} {passages[k]} {text(rng, 20)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = {r.doc_id: r for r in repeated_spans(docs).collect()}
    assert set(spans) == {100 + k for k in range(60)}
    texts = dict(rows)
    for k in range(60):
        r = spans[100 + k]
        piece = texts[100 + k].encode()[r.start : r.start + r.length]
        assert passages[k].encode() in piece and piece in texts[k].encode() and r.n_words >= 51
    left = {r.doc_id: r.text for r in dedup_documents(docs).collect()}
    assert not any(passages[k] in left[100 + k] for k in range(60)) and all(left[k] == texts[k] for k in range(60))


def test_ends_beyond_the_first_look(spark):
    rng = random.Random(3)
    same = "z" * 3000  # no cut inside: one chunk with different surroundings
    rows = [(k, f"{text(rng, 20)} {same} é{text(random.Random(1), 40)}é {same} {text(rng, 20)}") for k in range(2)]
    (r,) = repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert r.doc_id == 1 and r.length > 6200
    assert rows[1][1].encode()[r.start : r.start + r.length] in rows[0][1].encode()


def test_first_byte_is_part_of_the_digest():
    rng = random.Random(2)
    for _ in range(100):
        t = text(rng, 30)
        a, b = (chunk_texts(pa.array([c + t]))[-1][0] for c in "AZ")
        assert a != b


def test_texts_that_differ_in_their_first_byte(spark):
    rng = random.Random(6)
    rows = []
    for k in range(20):
        t = text(rng, 40)
        rows += [(2 * k, "A" + t), (2 * k + 1, "Z" + t)]
    for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        piece = dict(rows)[r.doc_id].encode()[r.start : r.start + r.length]
        assert r.start == 1 and piece in dict(rows)[r.first_doc_id].encode()


def test_pieces_of_two_documents_are_no_passage(spark):
    """P (doc 1) and Q (doc 2), 15 words each, side by side in doc 3."""
    rng = random.Random(8)
    rows = []
    for k in range(30):
        p, q = text(rng, 15), text(rng, 15)
        rows += [(10 * k + 1, p), (10 * k + 2, q), (10 * k + 3, f"{p} {q}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeated_spans(docs).collect() == []
    assert sorted(map(tuple, dedup_documents(docs).collect())) == sorted(rows)


def test_a_common_chunk_inside_does_not_split_a_passage(spark):
    rng = random.Random(12)
    stock = text(rng, 9)
    passage = f"{text(rng, 20)} {stock} {text(rng, 20)}"
    rows = [(1, f"{text(rng, 10)} {stock} {text(rng, 10)}"), (2, passage), (3, f"{text(rng, 10)} {passage} {text(rng, 9)}")]
    spans = [r for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id == 3]
    assert len(spans) == 1 and spans[0].first_doc_id == 2 and spans[0].n_words >= 49


def test_whole_small_table_against_brute_force(spark):
    """Every passage stands in its first document; shared passages of 51 words are found."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    texts = {i: (t or "") for i, t in rows}
    covered = {}
    for r in QUERIES["op10_substring_dedup"](spark, SMALL).collect():
        raw = texts[r.doc_id].encode()
        assert raw[r.start : r.start + r.length] in texts[r.first_doc_id].encode() and r.first_doc_id < r.doc_id
        assert len(raw[r.start : r.start + r.length].split()) >= r.n_words >= 25
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    first, missed, shared = {}, 0, 0
    for i in sorted(texts):
        raw = texts[i].encode()
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        for a in range(len(words) - 50):
            window = raw[words[a][0] : words[a + 50][1]]
            if first.setdefault(window, i) != i:
                shared += 1
                missed += not covered.get(i, set()).issuperset(range(words[a][0], words[a + 50][1]))
    assert shared > 0 and missed <= 0.01 * shared
