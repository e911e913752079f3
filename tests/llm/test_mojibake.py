from __future__ import annotations

import random

from folia.llm import mojibake as M

CLEAN = [
    "La procédure déjà compilée n’est jamais réévaluée, même si l’état a été modifié.",
    "Für jede Prüfung werden höchstens neun Einträge geändert; größere Felder müssen kürzer sein.",
    "El código de señal será válido; ¿qué ocurre después de la compilación? También números pequeños.",
    "Раздел описывает порядок работы компилятора и редактора, память освобождается автоматически.",
    "編集画面を閉じる前に、必ず作業内容を保存します。この節では動作を説明します。",
    "The author’s café example — already déjà vu — costs 40 £ or 45 €; see § 3 at ±5 °C.",
    "The characters Ã, Â and â are members of the upper half.",
    "SEÇÃO: ORGANIZAÇÃO E PADRÕES. ATENÇÃO: NÃO DESLIGUE A MÁQUINA.",
]


def corpus():
    rnd = random.Random(3)
    docs = []
    for k in range(500):
        docs.append("Plain words come first. " + " ".join(rnd.choice(CLEAN) for _ in range(rnd.randint(1, 3))) + " And last.")
    return docs


def test_found_and_restored():
    docs = corpus()
    bad = {}
    for k, pair in enumerate([("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp1251"), ("utf-8", "cp1252", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1251", "cp1252"), ("koi8-r", "cp1251")]):
        for j, clean in enumerate(c for c in CLEAN[:6] if not c.startswith("The characters")):
            g = M.misread(clean, pair)
            if g is not None and g != clean:
                bad[f"{k}-{j}"] = (f"Before it. {g} After it.", f"Before it. {clean} After it.")
    model = M.fit(docs + [b for b, _ in bad.values()])
    assert [d for d in docs if model.label(d)] == []
    spans = {k: model.label(b) for k, (b, _) in bad.items()}
    assert sum(map(bool, spans.values())) >= 0.97 * len(bad)
    right = sum(M.repaired(b, spans[k])[0] == clean for k, (b, clean) in bad.items())
    assert right >= 0.8 * len(bad)
    lossy = "Avant. La mémoire réservée à l’état.".encode("cp1252").decode("utf-8", "replace")
    assert model.label(lossy) and M.repaired(lossy, model.label(lossy))[0] == lossy
    assert model.label("") == [] and model.label("plain ascii") == []


def test_inverse_pairs():
    for pair in M.PAIRS:
        if "utf-8" in pair[1:] or set(pair[1:]) & {"cp932", "gbk", "ascii"}:
            continue
        for text in ("déjà vu", "Раздел", "節"):
            g = M.misread(text, pair)
            assert g is None or M.restore(g, pair) == text, (pair, text)


def test_rows(spark):
    docs = corpus()[:200]
    garbled = M.misread(CLEAN[0], ("utf-8", "cp1252"))
    rows = [(k, t, "x") for k, t in enumerate(docs)] + [(1000, garbled, None), (1000, garbled, None), (1001, None, None), (1002, "", None), (1003, "ascii", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_spans string")
    got = M.restored(df, id_col="doc_id").collect()
    assert [r.doc_id for r in got] == [1000, 1000] and got[0].restored_text == CLEAN[0]
    assert M.restored(df.where("false"), id_col="doc_id").collect() == []


def test_model_comes_from_all_documents(spark):
    """More documents than any bound, garbled and lossy ones among them: the model is that of all, whatever the partitions."""
    rnd, docs = random.Random(5), corpus()
    texts = [f"{rnd.choice(docs)} {k}" for k in range(5_500)] + ["ascii only", "zero \0é and é\0"]
    texts += [M.misread(CLEAN[k % 3], ("utf-8", "cp1252")) + f" {k}" for k in range(90)] + ["Avant. La mémoire réservée.".encode("cp1252").decode("utf-8", "replace")] * 3
    texts += ["þorn stands here"] * 2
    whole = M.fit(t for t in texts if not t.isascii())
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    for part in (df, df.repartition(3)):
        got = M.fitted(part, text_col="text")
        assert ord("þ") in got.signs and (got.pairs == whole.pairs).all() and (got.signs == whole.signs).all() and (got.rows == whole.rows).all()
        assert (got.enter, got.leave) == (whole.enter, whole.leave)
