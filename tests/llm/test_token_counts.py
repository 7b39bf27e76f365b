import random

import public_tokenizers
from tokenizers import Tokenizer

from riskmart.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_equals_the_library(spark, monkeypatch):
    draw = random.Random(2)
    letters = "aaab  \n\t\r.,!'s't123é\x1c\x85​\xa0 漢字😀᠎\x00ªº²̀"
    texts = ["".join(draw.choice(letters) if draw.random() < 0.9 else draw.choice(["<|endoftext|>", "a" * 20, "don't", chr(draw.randrange(0x20, 0xD7FF))]) for _ in range(draw.randrange(60))) for _ in range(1500)]
    texts += ["", None, "a" * 50_000, "abcdefghij" * 3000, "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext", "word " * 40_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    encoded = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    want = [(i, len((t or "").encode()), len(e.ids), len(e.ids) > 512) for i, (t, e) in enumerate(zip(texts, encoded, strict=True))]
    assert sorted(tuple(r) for r in T.token_counts(df, PATH).collect()) == want
    monkeypatch.setattr(T, "CACHE", 10)
    assert sorted(tuple(r) for r in T.token_counts(df.union(df), PATH).collect()) == sorted(want + want)


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert {tuple(r) for r in T.token_counts(df, PATH, limit=1).collect()} == {(None, 3, 2, True), (None, 0, 0, False)}
    assert T.token_counts(df.where("false"), PATH).count() == 0
