import random
import re

from riskmart.llm import quality_rules as Q

LIMITS = {
    "few_words": lambda m: m["n_words"] < 20, "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"], "repeated_lines": lambda m: m["n_lines"] >= 4 and 100 * m["n_dup_lines"] > 40 * m["n_lines"],
    "short_words": lambda m: 2 * m["word_chars"] < 5 * m["n_words"], "long_words": lambda m: m["word_chars"] > 20 * m["n_words"],
    "capitals": lambda m: 100 * m["n_upper"] > 50 * m["word_chars"], "exclamations": lambda m: 10 * m["n_exclaims"] > 3 * m["n_words"],
    "stutter": lambda m: 100 * m["n_stutter"] > 20 * m["n_words"],
}


def brute(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    repeated = {x for x in windows if windows.count(x) > 1}
    covered = {i + k for i, x in enumerate(windows) if x in repeated for k in range(8)}
    m = {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_upper": len(re.findall("[A-Z]", text)),
        "n_exclaims": text.count("!"), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_stutter": sum(a == b for a, b in zip(w, w[1:], strict=False)), "n_repeat_words": len(covered),
    }
    return m | {"rule_bits": sum(1 << i for i, rule in enumerate(Q.RULES) if LIMITS[rule](m))}


def texts():
    draw = random.Random(9)
    make = lambda n, v: " ".join(draw.choices([f"word{i}" for i in range(v)], k=n))
    out = [None, "", " \n\t\x0b ", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 300, "LOUD WORDS!! " * 20, "é😀 " * 25, "a b c " * 30]
    out += [make(n, v) for n in (5, 19, 20, 60, 200) for v in (2, 5, 1000)] + [make(10, 9) + "\n" + "same line here\n" * k + " \n\n" + make(30, 500) for k in (1, 2, 6)]
    out += ["### $$$ " + make(25, 99), "| ".join(f"c{i}" for i in range(40)), "\r\n".join(["dup"] * 9), "supercalifragilisticexpialidocious" * 2 + " x" * 3]
    return out + [" ".join(draw.choices("ab", k=60)) for _ in range(10)]


def test_equals_brute_force(spark):
    data = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in data + data[:3]], "doc_id long, text string, n_words string, kept int")
    got = Q.judged(Q.ledger(df)).collect()
    assert len(got) == len(data) + 3
    for r in got:
        want = brute(dict(data)[r.doc_id])
        assert {k: r[k] for k in want} == want, (dict(data)[r.doc_id], want)
        assert r.base_failed == bool(want["rule_bits"] & 3) and r.kept == (want["rule_bits"] == 0)


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota " * 20_000)], "doc_id long, text string")
    r = Q.ledger(df).first()
    assert r.n_words == r.n_repeat_words == 180_000
    assert Q.judged(Q.ledger(df.where("false"))).count() == 0


def test_policies_and_ablation(spark):
    rows = Q.ledger(spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string"))
    bits = [r.rule_bits for r in rows.collect()]
    for policy, rules in Q.POLICIES.items():
        mask = Q.mask_of(rules)
        assert sorted(r.kept for r in Q.judged(rows, policy).collect()) == sorted(b & (mask | 3) == 0 for b in bits)
        got = {r.rule: r for r in Q.ablation(rows, policy).collect()}
        assert list(got) == list(rules)
        for rule in rules:
            bit = Q.mask_of((rule,))
            alone = sum(b & mask == bit for b in bits)
            kept = sum(b & mask == 0 for b in bits)
            assert (got[rule].n_failed, got[rule].n_failed_alone, got[rule].n_kept_without) == (sum(b & bit > 0 for b in bits), alone, kept + alone)


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = Q.judged(Q.ledger(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
