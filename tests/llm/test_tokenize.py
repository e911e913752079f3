from __future__ import annotations

import random

import pytest

from folia.llm import tokenize as T


@pytest.fixture(scope="module")
def enc():
    return T.encoder(*T.vocabulary())


def test_concatenation_is_exact(enc, monkeypatch):
    rnd = random.Random(7)
    parts = ["a", "b", " ", "  ", "\n", "1", "'", "s", "é", "日", "。", "!", " the", "'ll", "\t", "<|endoftext|>"]
    for n in range(500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 300))) if n % 2 else rnd.choice(["a", "aaab", "1", "日本語", "=-", "\n "]) * rnd.randint(1, 200) + rnd.choice(["", "x ", "'s"])
        monkeypatch.setattr(T, "LEAF_CHARS", rnd.choice([3, 7, 50, 400]))
        monkeypatch.setattr(T, "LEAF_BYTES", rnd.choice([4, 64]))
        assert enc.encode(text) == enc.bpe.encode_ordinary(text)


def test_rows(spark, enc):
    rows = [(1, "hello world", "x"), (2, None, "x"), (3, "", "x"), (4, "word " * 500 + "z" * 3000, None), (4, "hello world", None), (5, "日本" * 1500, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = sorted((i, enc.bpe.encode_ordinary(t or "")) for i, t, _ in rows)
    for spread in (T.SPREAD_CHARS, 700):  # whole texts, and long ones spread over tasks
        got = T.encode_texts(df, spread_chars=spread)
        assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == want
    assert T.encode_texts(df.where("false")).collect() == []
    for i, t, _ in rows:
        assert enc.bpe.decode(enc.encode(t or "")) == (t or "")
