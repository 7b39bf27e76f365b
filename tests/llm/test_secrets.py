import hashlib
import random
import re

from riskmart.llm import secrets as S

FOLDER = "/root/testdata/sf0.01"
A = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    found = [("assign", m.start(), m.end()) for m in A.finditer(text) if len(m[1]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(found, key=lambda x: (x[1], S.KINDS.index(x[0]))))


def rows():
    draw = random.Random(3)
    hexes = lambda n: "".join(draw.choices("0123456789abcdef", k=n))
    pieces = [
        lambda: f'token = "{hexes(40)}"', lambda: f"API_KEY: {hexes(30).upper()}", lambda: "AKIA" + "".join(draw.choices("ABCDEFGHIJ0123456789", k=draw.choice([10, 16, 20]))),
        lambda: hexes(draw.choice([23, 24, 64])), lambda: "password=short", lambda: "Secret=a", lambda: "token=token:abcdef12", lambda: "ſecret=abcdefgh toKen=abcdefgh",
        lambda: "4734663219866878", lambda: "2024-01-02-03-04-05-06", lambda: "héllo wörld 漢字", lambda: "pÄsswd='abcdef", lambda: "deadbeefdeadbeefdeadbeefdead",
        lambda: "1234567890123456789012", lambda: "order-2024-000000000017",
    ]
    out = [(i, " ".join(draw.choice(pieces)() for _ in range(draw.randrange(6)))) for i in range(400)]
    return out + [(900, None), (901, ""), (902, "x " * 50_000 + 'secret="abcdef"'), (903, "a1" * 30_000), (904, "token=abcdef"), (904, "token=abcdef")]


def test_base_spans(spark):
    data = rows()
    got = S.scan(spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, spans string")).collect()
    want = sorted((i, hashlib.sha256(brute(t or "").encode()).hexdigest(), *[brute(t or "").count(k + ":") for k in S.KINDS[:3]]) for i, t in data)
    assert sorted((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got) == want
    for r in got:
        kept = ",".join(x for x in r.spans.split(",") if not x.startswith("model:"))
        assert kept == brute(dict(data)[r.doc_id] or "")


def test_network_adds_unlabelled_secrets(spark):
    data = rows()
    new = ["the key is Zx9Qw3Rt7Yp1Lk5Jh8Gf2Ds ok", "use 9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B now"]
    clean = ["card 4734663219866878 here", "words thththththththththththth only", "on 2024-01-02-03-04-05-07 we", "see order-2024-000000000099"]
    df = spark.createDataFrame(data + [(1000 + i, t) for i, t in enumerate(new + clean)], "doc_id long, text string")
    got = {r.doc_id: r for r in S.scan(df).collect()}
    assert [got[1000 + i].n_model for i in range(len(new))] == [1] * len(new)
    assert [got[1000 + len(new) + i].n_model for i in range(len(clean))] == [0] * len(clean)


def test_windows_and_recall():
    codes = S.windows_of("y" * 200, 20, 190)
    assert len(codes) % S.WIDTH == 0 and len(codes) // S.WIDTH == 1 + -(-(170 + 32 - S.WIDTH) // S.STRIDE)
    draw = random.Random(1)
    make = lambda alphabet: S.windows_of(f"key {(t := ''.join(draw.choices(alphabet, k=32)))} end", 4, 4 + len(t))
    positive, negative = [make("0123456789abcdef") for _ in range(200)], [make("0123456789-") for _ in range(200)]
    net = S.fit(positive, negative)
    assert (net.scores([make("0123456789abcdef") for _ in range(200)]) >= net.threshold).mean() > 0.9
    assert (net.scores([make("0123456789-") for _ in range(200)]) >= net.threshold).mean() < 0.05
    assert S.fit([], negative) is None


def test_empty(spark):
    assert S.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_recall_holds_with_few_positives():
    """60 positives among 2,600 negatives that look alike: the threshold lies where the recall is kept, however low."""
    draw = random.Random(5)
    make = lambda alphabet, n: S.windows_of(f"id {(t := ''.join(draw.choices(alphabet, k=n)))} x", 3, 3 + len(t))
    positive = [make("0123456789abcdefghij", 20) for _ in range(60)]
    negative = [make("0123456789abcdefghijkl", 20) for _ in range(2600)]
    net = S.fit(positive, negative, epochs=3)
    assert net.recall >= 0.99 and net.threshold < 0.5


def test_candidates_are_all_runs_but_words():
    every = lambda text: [text[c["s"] : c["e"]] for c in S.candidates(text, S.base_spans(text))]
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.SflKxwRJSMeKKF2QT4fw"
    probes = ["hunter2hunter2", "AbCdEfGhIjKlMnOpQrStUvWx", token, "x" * 20, "a1b2c3d4", "abcdefgh=/abc1"]
    for probe in probes:
        assert every(f"see {probe}, then") == [probe], probe
        assert S._suspects(S.pa.array([f"see {probe}. then"]))[0]
    for words in ("International and National.Next", "well-known to-day UPPERCASE_WORDS", "short1", "misinterpretation.", "a/b.c-d"):
        assert every(words) == []
    inside = S.candidates("token=abcdef123456 zz" + "0123456789abcdef01234567" + "ZZ", S.base_spans("token=abcdef123456 zz" + "0123456789abcdef01234567" + "ZZ"))
    assert [(c["known"], c["inside"]) for c in inside] == [(True, True), (True, False)]


def test_every_finding_is_fitted_and_counted(spark, tmp_path, monkeypatch):
    """Several parts: the network learns from all of them, and the threshold keeps the recall over all held-back findings."""
    draw = random.Random(9)
    make = lambda alphabet: "".join(draw.choices(alphabet, k=24))
    texts = [f'token="{make("0123456789abcdefghij")}" and {make("0123456789-") + "7"}' for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    store = S.Store(spark, "test-secrets")
    found = store.put(S.batches_of(spark, df, S.find_batches, S.FOUND_DDL), "found")
    seen, settle = [], S.settle
    monkeypatch.setattr(S, "settle", lambda net, z, label, count, recall: seen.append((label, count)) or settle(net, z, label, count, recall))
    net = S.trained(found, store, part_rows=1000)
    findings = found.selectExpr("explode(cands) as c").selectExpr("c.known", f"substring(c.x, 1, {S.WIDTH}) as x").distinct().cache()
    held = findings.where("pmod(xxhash64(x), 4) = 0")
    assert findings.count() > 2 * 1000 and seen[0][1].sum() == held.count() and seen[0][1][seen[0][0] == 1].sum() == held.where("known").count()
    assert net.recall >= 0.99
    scores = net.scores([bytes(r.x) for r in held.where("known").collect()])
    assert (scores >= net.threshold).mean() >= 0.98
    assert (net.scores([bytes(r.x) for r in held.where("not known").collect()]) >= net.threshold).mean() < 0.05
