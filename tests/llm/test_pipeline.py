import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from graphloom.llm.poisson_mixing import MAX_RATE, SEED, source_rates
from graphloom.llm.scratch import materialize, release
from tests.conftest import SMALL
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    """Whole small table plus rows of every odd kind."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*cp.COLUMNS)
    odd = [(None, "a text without id, a@b.c", None, None, None), (None, None, "en", "src1", 0), (9001, "", "en", None, 0), (9002, None, None, "src2", None),
           (9003, "call +1 (456) 555-2186 now " * 40, "en", "rare", 5), (9003, "call +1 (456) 555-2186 now " * 40, "en", "rare", 5)]
    return materialize(docs.unionByName(spark.createDataFrame(odd, SCHEMA)), "stage-test")


def rows(df):
    return sorted((tuple(r) for r in df.select(*cp.COLUMNS).collect()), key=str)


def test_toxicity_stage_only_drops_rows(spark, documents):
    out = cp.drop_toxic(spark, documents, SMALL)
    assert out.columns == list(cp.COLUMNS)
    kept, given = rows(out), rows(documents)
    assert all(kept.count(r) == given.count(r) for r in kept)


def test_near_duplicate_stage_keeps_one_of_each_group(spark, documents):
    out = rows(cp.drop_near_duplicates(spark, documents, SMALL))
    given = [tuple(r) for r in documents.collect()]
    groups = brute.near_groups([(k, r[1]) for k, r in enumerate(given)], 5, 80)
    members = {}
    for k, g in enumerate(groups):
        members.setdefault(g, []).append(given[k])
    want = sorted((min(m, key=lambda r: (r[0] is None, r[0] or 0)) for m in members.values()), key=str)
    assert out == want
    # frames that do not come straight from files are handled too
    assert rows(cp.drop_near_duplicates(spark, documents.repartition(3), SMALL)) == want


def test_personal_data_stage_masks_base_spans(spark, documents):
    out = {(r[0], r[2], r[3]): r for r in rows(cp.mask_personal_data(spark, documents, SMALL))}
    for r in rows(documents):
        got = out[(r[0], r[2], r[3])]
        found = sum(map(len, brute.pii(r[1]).values()))
        if found:
            assert "[PII]" in got[1] and got[4] == len(got[1])
        elif "[PII]" not in (got[1] or ""):
            assert got == r


def test_mixing_stage_repeats_by_poisson_counts(spark, documents):
    rates = {r[0]: (r[1], r[2]) for r in source_rates(documents, alpha=cp.SOURCE_ALPHA).collect()}
    want = []
    docs = rows(documents)
    for r, name in zip(docs, brute.mixing_names(docs)):
        rate, strata = rates["-" if r[3] is None else f"={r[3]}"]
        assert rate <= MAX_RATE
        want += [r] * sum(brute.poisson_count(SEED, name, k, rate) for k in range(1, strata + 1))
    assert rows(cp.mix_to_weights(spark, documents, SMALL)) == sorted(want, key=str)


def test_run_and_empty(spark, documents):
    out = cp.run(spark, SMALL)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "personal_data", "source_mixing", "packing"]
    per = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert out.count() > 0 and per.where("n > 2048").count() == 0
    docs = materialize(documents.limit(0), "stage-none")
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SMALL), "stage-none")
        assert docs.count() == 0, name
    assert release(spark) > 0
