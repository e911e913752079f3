from __future__ import annotations

import random

import numpy as np
import pytest

from folia.llm import leakage as L


def test_words():
    want = ["the", "tidy", "pigeon", "counts", "5", "kilns"]
    for text in ("The tidy pigeon counts 5 kilns.", "THE TIDY PIGEON, COUNTS 5 KILNS", "> The tidy\n> pigeon counts\n> 5 kilns", "The <b>tidy</b> pigeon **counts** \\emph{5} kilns", "The\u2009tidy\u00a0pi-\ngeon counts ５ kilns", "The [tidy](a/b.md) pigeon counts 5 kіlns"):
        assert L.words(text) == want, text
    assert L.words("") == []


def hashed(tokens):
    return L.Hashes().of(" ".join(t.replace(".", "x") for t in tokens))


def test_chunks_give_the_same_words():
    texts = ["Fi\u200bne ﬁne ＡＢ", "é e\u0301 naïve", "a_b c-d «x»", "Ⅷ ½ x²", "日本語テキスト。", "pi-\n  geon", "a\u00a0b", "<b>x</b>y", "İstanbul ẞ", "к\u0306 x\u0338"]
    for t in texts:
        assert L.Hashes().of(t).tolist() == hashed(L.words(t)).tolist(), t


def plain_stretch(item, doc):
    """Words and edits of the longest stretch by the full table of every pair of starts."""
    best = (0, 0)
    for i in range(len(item)):
        for j in range(len(doc)):
            row = list(range(len(doc) - j + 1))
            for x in range(1, len(item) - i + 1):
                new = [x]
                for y in range(1, len(row)):
                    new.append(min(row[y] + 1, new[-1] + 1, row[y - 1] + (item[i + x - 1] != doc[j + y - 1])))
                row = new
                e = min(row)
                if e <= L.CHANGED * x:
                    best = max(best, (x, -e))
    return best[0], -best[1]


def test_stretches_with_words_put_in_and_left_out():
    rnd = random.Random(4)
    for _ in range(25):
        item = [rnd.randrange(10**6) for _ in range(rnd.randint(20, 26))]
        doc = list(item)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(doc))
            doc[at : at + rnd.randint(0, 1)] = [rnd.randrange(10**6) for _ in range(rnd.randint(0, 1))]
        doc = [1, 2, 3, *doc, 4, 5]
        h = np.array(doc, np.uint64)
        got = dict((k, (n, e)) for k, n, e in L.Probe([("i", item)]).found(h))
        want = plain_stretch(item, doc)
        assert got.get("i", (0, 0))[0] == (want[0] if want[0] >= len(item) / 2 else 0)


def test_short_items_have_their_own_grams():
    assert L.gram_words(2) == 1 and L.gram_words(40) == L.LONGEST_GRAM
    probe = L.Probe([("short", [7, 8]), ("long", list(range(100, 140)))])
    assert set(probe.tables) == {1, L.LONGEST_GRAM}
    assert {k for k, _, _ in probe.found(np.array([1, 7, 8, 2, *range(100, 125)], np.uint64))} == {"short", "long"}


def test_winnowing_guarantee():
    rnd = random.Random(9)
    for _ in range(60):
        k, w = rnd.randint(2, 5), rnd.randint(1, 4)
        shared = [str(rnd.random()) for _ in range(w + k - 1)]
        a = [str(rnd.random()) for _ in range(20)] + shared + ["x"] * 5
        b = ["y"] * 3 + shared + [str(rnd.random()) for _ in range(9)]
        ga, gb = L.grams(hashed(a), k), L.grams(hashed(b), k)
        assert set(ga[L.winnow(ga, w)]) & set(gb[L.winnow(gb, w)])
    assert len(L.winnow(L.grams(hashed(["a"]), 3), 2)) == 0


@pytest.mark.parametrize("held_words", [L.HELD_WORDS, 0])
def test_rows(spark, held_words):
    rnd = random.Random(1)
    voc = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ran", "tol", "vik", "dus", "wem", "gil", "hob")]
    items = [(k, " ".join(rnd.choice(voc) for _ in range(40))) for k in range(20)]
    opening = "read the passage below with care and then answer the question "
    items = [(k, opening + t if k < 10 else t) for k, t in items]
    fill = lambda n: " ".join(rnd.choice(["one", "two", "three", "four"]) + str(rnd.randrange(99)) for _ in range(n))
    docs, want = [], set()

    def add(text, *leaked):
        docs.append((len(docs), fill(30) + "\n" + text + "\n" + fill(20), "x"))
        want.update((len(docs) - 1, i) for i in leaked)

    for i, t in items:
        w = t.split()
        add(t.upper(), i)
        half = w[: (len(w) + 1) // 2]
        add(" ".join(half), i)
        add(" ".join(w[: len(w) * 2 // 5]))
        changed = list(w)
        for p in range(5, len(w), 11):
            changed[p] = "changed"
        add("; ".join(changed), i)
        add(" ".join(rnd.sample(w, len(w))))
        many = [x if p % 4 else "other" for p, x in enumerate(w)]
        add(" ".join(many))
    docs += [(9000, None, None), (9001, "", None), (3, docs[3][1], "again")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame([*items, (50, None), (51, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(d, i, held_words=held_words).collect()}
    assert got == want
    assert L.leaks(d.where("false"), i, held_words=held_words).collect() == [] and L.leaks(d, i.where("false"), held_words=held_words).collect() == []
