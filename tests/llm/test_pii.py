import random

from pyspark.sql import functions as F

from graphloom.llm.pii_bootstrap import extract, found_spans, numbered_spans, redact, span_text
from tests.llm import brute

BASE = ("email", "ip", "card", "phone")


def digest(df):
    return df.select(
        "row", "doc_id", *[F.size(k).alias(f"n_{k}") for k in BASE], F.sha2(span_text(numbered_spans(BASE)), 256).alias("sha"),
        span_text(F.concat(numbered_spans((*BASE, "secret")), found_spans())).alias("spans"),
    )


def texts():
    rng = random.Random(3)
    alphabet = "0123456789 ..--@+()ab é\n55"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(1500)]
    card = "4041894974608795"
    pieces = [card, "4041 8949-7460 8795", "1.2.3.4", "001.02.3.255", "256.1.1.1", "1.2.3.4.5.6.7.8", "a@b.c", "a@b.c_x@d.e", "a@b", "a@b.c@d.e",
              "+1 (456) 555-2186", "+1 2", "+12345678 ", "4" * 40, "+1+23456789012", "x@y.z.", "%@a.b", "9" * 60 + ".1.1.1", "0" * 30 + "1.2.3.4"]
    out += [rng.choice(["", " ", "1", "x ", "9-", "é", "𝒳 "]) + p + rng.choice(["", ".", " 3", "-", "@x.y", "_"]) for p in pieces for _ in range(12)]
    return out + ["", "a" * 200_000 + "@", "1 " * 50_000, "9" * 100_000, "+" + "1 " * 20_000]


def test_base_spans_match_python_patterns(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(-1, None, "x"), (None, "a@b.c", "x"), (3, "a@b.c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, email string").repartition(6)
    text_of = {}
    for i, t, _ in rows:
        text_of.setdefault(i, []).append(t)
    out = digest(extract(docs)).collect()
    assert len(out) == len(rows)
    for r in out:
        options = [([len(v) for v in brute.pii(t).values()], brute.pii_digest(t)) for t in text_of[r.doc_id]]
        assert ([r[f"n_{k}"] for k in BASE], r.sha) in options, (r, text_of[r.doc_id])
    assert extract(docs.limit(0)).collect() == []


def test_patterns_induced_by_seeds_find_new_identifiers(spark):
    rng = random.Random(1)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(40)]
    rows = [f'log token = "{h}" end' for h in hexes]
    rows += [f"contact: user{i}@mail.example.com now" for i in range(30)]
    rows += ['log token = "hunter-two" end', "contact: bob_at_home now"]  # unseen identifiers in known contexts
    rows += [f"note: ordinary word{i}" for i in range(50)] + ["note: a@b.cc"]  # a context that proves nothing
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r.doc_id: r for r in digest(extract(docs)).collect()}
    assert out[70].spans == "secret:13:23" and rows[70][13:23] == "hunter-two"
    assert out[71].spans == "email:9:20" and out[71].n_email == 0 and rows[71][9:20] == "bob_at_home"
    assert all(out[i].spans == "" for i in range(72, 122))
    assert out[0].spans == "secret:13:53"


def test_redaction(spark):
    rows = [(1, "mail a@b.c and +1 (456) 555-2186."), (2, None), (3, ""), (4, "plain"), (5, "é 1.2.3.4 é 1.2.3.4")]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, row int")
    out = {r.doc_id: r for r in redact(docs).collect()}
    assert out[1].text == "mail [PII] and [PII]." and out[2].text is None and out[3].text == ""
    assert out[4].text == "plain" and out[5].text == "é [PII] é [PII]" and out[1].row == 7
    assert redact(docs.limit(0)).collect() == []
