from __future__ import annotations

from folia.llm import lookalike as K

SAME = [("cafe\u0301", "café"), ("ｒｅｃｏｒｄ", "record"), ("is bound", "іs bound"), ("deﬁnition", "definition"), ("a\u200bb", "ab"), ("a\u00adb", "ab"), ("a\u00a0b", "a b"), ("a\u2009b", "a b"), ("x\u2010y", "x-y"), ("5 \u212a", "5 K"), ("\u2126;", "Ω\u037e"), ("\u00b5", "\u03bc"), ("ТОР", "TOP"), ("νοte", "vote"), ("\ufeffa", "a"), ("a\tb", "a b")]
OTHER = [("cafe", "café"), ("The", "the"), ("10¹", "101"), ("cell", "ce11"), ("l", "I"), ("и", "n"), ("ė", "e"), ("a b", "a\nb"), ("<b>a</b>", "a"), ("a¬\n", "a\n"), ("½", "1/2"), ("ſ", "s")]


def test_classes():
    spell = K.Speller(K.fit(["the cell holds a note and a record"] * 3 + ["раздел описывает порядок работы"] * 3))
    for a, b in SAME:
        assert spell.form(a) == spell.form(b), (a, b)
    for a, b in OTHER:
        assert spell.form(a) != spell.form(b), (a, b)
    assert spell.form("порядок работы") == "порядок работы"
    assert spell.form("tһе сеll") == "the cell"
    assert spell.form("") == ""
    once = spell.form("Ｔｈе ﬁrst νοte")
    assert spell.form(once) == once


def test_rows(spark):
    rows = [(f"s{k}", a, b, "x") for k, (a, b) in enumerate(SAME)] + [(f"o{k}", a, b, "x") for k, (a, b) in enumerate(OTHER)]
    rows += [("n1", None, "a", None), ("n2", "a", None, None), ("e", "same", "same", None), ("s0", *SAME[0], "y"), ("z", "", "", None)]
    df = spark.createDataFrame(rows, "id string, source_text string, ocr_text string, _h string")
    assert sorted(r.id for r in K.same_look(df).collect()) == sorted(f"s{k}" for k in range(len(SAME)))
    n = {r.id: r for r in K.normalized(df, id_col="id", text_cols=["source_text", "ocr_text"]).collect()}
    assert n["n1"].source_text is None and n["z"].ocr_text == ""
    assert K.same_look(df.where("false")).collect() == []


def test_scores_decide_nearly_alike_signs():
    """Signs that no class holds, put into words that the bigrams were not counted on."""
    words = "manual reading window command number operation region history shape angle garden hundred holding young journey opening".split()
    spell = K.Speller(K.fit(words))
    back = {v[0]: k for k, v in K.NEAR.items() if k not in K.REPRESENTATIVE and ord(k) not in K.REPRESENTATIVE}
    changed = n = 0
    for w in "hanging change anyhow gathering nothing enough jogging".split():
        for i, c in enumerate(w):
            if c in back:
                odd = w[:i] + back[c] + w[i + 1 :]
                n += 1
                changed += spell.form(odd) == spell.form(w)
    assert n > 20 and changed / n > 0.9
    home = ["հայոց", "որոնց"]
    spell = K.Speller(K.fit(words + home * 5))
    assert [spell.form(w) for w in home] == home and spell.form("nո") == "nn"


def test_bigrams_come_from_all_rows(spark):
    """More rows than any bound, null texts among them; the pairs do not depend on partitions."""
    words = ["the cell holds a note", "раздел описывает порядок", "café und größer", None, "編集画面 を保存", ""]
    rows = [(k, f"{words[k % 6]} {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" if words[k % 6] else words[k % 6]) for k in range(9_000)]
    df = spark.createDataFrame(rows, "id long, t string")
    whole = K.fit(t for _, t in rows if t)
    pairs = K.speller_pairs(df, ["t"])
    assert sum(n for (x, _), n in pairs.items() if not x) == sum(n for (x, _), n in whole.items() if not x)
    assert pairs == {k: n for k, n in whole.items() if not k[0] or K.CHOSEN.intersection(k)} == K.speller_pairs(df.repartition(7), ["t"])
    some, every = K.Speller(pairs), K.Speller(whole)
    for w in ("порядок", "cell", "tһе", "сеll", "größеr", "nո", "編集o画面", "хх", "xjq", "ԛԛ"):
        assert some.form(w) == every.form(w)


def test_unseen_pairs_cost_no_more_however_much_was_counted():
    """A word of unseen pairs stays in its script; with a fixed count for unseen pairs it left it."""
    one = K.fit(["the cell holds a note", "a box of paper", "she copies the place"])
    for n in (1, 10**6, 10**10):
        assert K.Speller({k: v * n for k, v in one.items()}).form("hhho") == "hhho"
