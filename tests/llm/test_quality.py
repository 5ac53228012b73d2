import random

from graphloom.llm.quality_ledger import BASE, POLICIES, ablation, apply_policy, ledger, policy_mask, rule_bit
from tests.llm import brute


def corpus():
    rng = random.Random(2)
    rows = [None, "", " \n\t", "word", "# $ % # &" * 9, "a b c d e f g h " * 40, "line one\n" * 30, "é ü ß " * 30, "x" * 50_000, "w " * 30_000]
    vocabulary = [f"v{i}" for i in range(12)] + ["#tag", "a|b"]
    rows += ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t", "\x0b", " "]) for _ in range(rng.randint(1, 90))) for _ in range(150)]
    rows += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(100)) for _ in range(20)]
    return rows


def test_measurements_match_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i if i != 4 else None, t, "clash") for i, t in enumerate(rows + rows[:3])], "doc_id long, text string, n_words string")
    out = apply_policy(apply_policy(ledger(docs)), BASE, "base_kept").collect()
    assert len(out) == len(rows) + 3
    for r, t in zip(out, rows + rows[:3]):
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, not r.base_kept)
        assert got == brute.quality(t), t
        assert not (r.kept and not r.base_kept)
    assert ledger(docs.limit(0)).collect() == []


def test_policies_and_ablation(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string")
    led = ledger(docs)
    rows = led.collect()
    table = {(r.policy, r.rule): r for r in ablation(led).collect()}
    assert set(table) == {(v, r) for v, rules in POLICIES.items() for r in rules}
    for (version, rule), r in table.items():
        mask, bit = policy_mask(version), rule_bit(rule)
        assert r.failed == sum(bool(x.fail_bits & bit) for x in rows)
        assert r.rejected == sum(bool(x.fail_bits & mask) for x in rows)
        assert r.only_this_rule == sum(x.fail_bits & mask == bit for x in rows)
    assert ablation(led.limit(0)).collect() == []
