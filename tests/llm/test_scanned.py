from __future__ import annotations

from folia.llm import scanned as S

DOC = "quillmere-network-hub-release-notes-6e"
BODY = ["Within the listener, storage for the oblique stanza comes from the register area, not", "from the microcode. During overflow recovery, when the static spool grows beyond 232", "entries, use the internal vector instead of the previous tableau of the loader."]
CODE = ["(let ((cell '[7 cell])) (trim cell))", "17", "  (setq *x* 3)"]


def text(lines):
    return "\n".join(lines)


CASES = {
    "bracket": (text([*BODY[:1], "[203]", *BODY[1:]]), {"page-number"}),
    "named": (text([*BODY, "Page 117"]), {"page-number"}),
    "roman": (text([*BODY, "xlvi"]), {"page-number"}),
    "of": (text(["47 of 102", *BODY]), {"page-number"}),
    "bare": (text([*BODY, "33"]), {"page-number"}),
    "title": (text(["QUILLMERE NETWORK HUB RELEASE NOTES", *BODY]), {"running-header"}),
    "product": (text(["Network Hub: Volatile clusters and the editor", *BODY]), {"running-header"}),
    "beside": (text([*BODY, "QUILLMERE Release Notes ... 28"]), {"running-header", "page-number"}),
    "left": (text(["84  Network Hub: Dormant beacons and the collector", *BODY]), {"running-header", "page-number"}),
    "broken": (text([BODY[0], "from the micro-", "code. During overflow recovery, when the static spool grows"]), {"hyphenation"}),
    "soft": (text([BODY[0], "from the micro\u00ad", "code. During overflow recovery"]), {"hyphenation"}),
    "across": (text([BODY[0], "from the micro-", "[7]", "code. During overflow recovery"]), {"hyphenation", "page-number"}),
    "misread": (text([BODY[0].replace("storage", "st0rage").replace("register", "rcgister"), *BODY[1:]]), {"misread"}),
    "clean": (text(BODY), set()),
    "code": (text(CODE), set()),
    "alike": (text([BODY[0].replace("area", "аrеа"), *BODY[1:]]), set()),
    "heading": (text(["Dormant cells and the evaluator", *BODY]), set()),
}


def rows():
    out = []
    for k in range(12):
        for name, (t, _) in CASES.items():
            source = text(CODE) if name == "code" else text(["Dormant cells and the evaluator", *BODY]) if name == "heading" else text(BODY)
            out.append((DOC, source, t))
    return out


def test_defects_and_paragraphs():
    m = S.fit(rows())
    manual = S._title_words(DOC)
    for name, (t, want) in CASES.items():
        for source in (None, text(CODE) if name == "code" else text(["Dormant cells and the evaluator", *BODY])):
            r = S.read(t, manual, S.Witness(source), m)
            assert r.defects == want, (name, source is None, r.defects)
    r = S.read(CASES["across"][0], manual, S.Witness(None), m)
    assert S.repaired(CASES["across"][0], r) == BODY[0] + " from the microcode. During overflow recovery"
    r = S.read(CASES["misread"][0], manual, S.Witness(text(BODY)), m)
    assert S.repaired(CASES["misread"][0], r) == " ".join(BODY)


def test_rows(spark):
    data = [(f"r{k}", d, s, t, t if k % 2 else None, "x") for k, (d, s, t) in enumerate(rows())]
    data += [("n", DOC, None, None, None, None), ("e", None, "", "", "", None), ("r0", *data[0][1:])]
    df = spark.createDataFrame(data, "id string, document_id string, source_text string, ocr_text string, canonical_text string, defect string")
    got = {(r.id, r.text_field, r.defect) for r in S.defects(df).collect()}
    want = set()
    names = list(CASES)
    for k in range(len(rows())):
        for d in CASES[names[k % len(names)]][1]:
            want |= {(f"r{k}", "ocr_text", d)} | ({(f"r{k}", "canonical_text", d)} if k % 2 else set())
    assert got == want
    assert S.defects(df.where("false")).collect() == [] and S.paragraphs(df.where("false")).collect() == []


def test_every_text_has_paragraphs(spark):
    data = [(f"r{k}", d, s, t, t if k % 2 else None) for k, (d, s, t) in enumerate(rows())]
    data += [("n", DOC, None, None, None), ("e", None, "", "", ""), ("one", DOC, None, BODY[0], None), data[0]]
    df = spark.createDataFrame(data, "id string, document_id string, source_text string, ocr_text string, canonical_text string")
    got = {(r.id, r.text_field): (r.repaired_text, r.had_defects) for r in S.paragraphs(df).collect()}
    assert set(got) == {(i, f) for i, _, _, o, c in data for f, t in (("ocr_text", o), ("canonical_text", c)) if t is not None}
    assert S.paragraphs(df).count() == len(got)
    names = list(CASES)
    for (i, field), (whole, had) in got.items():
        if i[0] == "r":
            name = names[int(i[1:]) % len(names)]
            assert had == bool(CASES[name][1])
            if name == "clean":
                assert whole == " ".join(BODY)
            if name == "code":
                assert whole == text(CODE)
    assert got["e", "ocr_text"] == got["e", "canonical_text"] == ("", False) and got["one", "ocr_text"] == (BODY[0], False)


def test_texts_of_one_line_are_labelled():
    m = S.fit(rows() + [(DOC, BODY[0], t) for t in ("Page 117", "[203]", "QUILLMERE NETWORK HUB RELEASE NOTES") for _ in range(9)])
    manual = S._title_words(DOC)
    for t, want in (("Page 117", {"page-number"}), ("[203]", {"page-number"}), ("QUILLMERE NETWORK HUB RELEASE NOTES", {"running-header"}), (BODY[0], set())):
        assert S.read(t, manual, S.Witness(BODY[0]), m).defects == want, t
    assert S.read("203", manual, S.Witness("203"), m).defects == set()


def test_lines_without_a_known_form_are_labelled_by_layout():
    rest = text(BODY)
    known = [(DOC, rest, text(["zq vx oddly set wording", *BODY])) for _ in range(40)]
    m = S.fit(rows() + known)
    r = S.read(text(["another strange small leader", *BODY]), S._title_words(DOC), S.Witness(rest), m)
    assert r.states[0] == 1 and "running-header" in r.defects


def test_hyphens_follow_the_witness():
    m, manual = S.fit(rows()), S._title_words(DOC)
    for source, want in (("use mirror-margin here", "use mirror-margin here"), ("use mirrormargin here", "use mirrormargin here")):
        t = "use mirror-\nmargin here"
        assert S.repaired(t, S.read(t, manual, S.Witness(source), m)) == want
    t = text([BODY[0], "from the micro-", "", "[53]", "", "code. During overflow recovery"])
    r = S.read(t, manual, S.Witness(None), m)
    assert r.defects == {"hyphenation", "page-number"} and S.repaired(t, r) == BODY[0] + " from the microcode. During overflow recovery"


def test_model_comes_from_all_regions(spark):
    """More regions than any bound: the model is that of all rows, whatever the partitions."""
    data = [(f"r{k}", d, s if k % 7 else None, t, None) for k, (d, s, t) in enumerate(rows()[:17] * 700)]
    data += [(f"w{k}", None, f"the zygomorph stands {'here' * (k + 1)}", "[12]\nthe zyg0morph stands", "the zygomorph stands") for k in range(9)]
    df = spark.createDataFrame(data, "id string, document_id string, source_text string, ocr_text string, canonical_text string")
    whole = S.fit((d, s, t) for _, d, s, t, _ in data if s is not None and t is not None)
    for part in (df, df.repartition(5)):
        got = S.fitted(part)
        assert "zygomorph" in got.lexicon and "herehere" not in got.lexicon
        assert (got.start, got.steps, got.symbols, got.forms, got.lexicon) == (whole.start, whole.steps, whole.symbols, whole.forms, whole.lexicon)


def test_misread_last_lines_are_no_headers():
    """However often the form was seen, a short last line whose words are misread ones of the witness is its text."""
    source = text([*BODY, "See the pending closure."])
    odd, other = text([*BODY, "thc pendlng cl0sure."]), text([*BODY, "zq vx oddly set."])
    m = S.fit(rows() + [(DOC, source, odd)] * 30 + [(DOC, source, other)] * 30)
    r = S.read(odd, S._title_words(DOC), S.Witness(source), m)
    assert r.defects == {"misread"} and r.fixes["cl0sure"] == "closure"
    assert S.read(other, S._title_words(DOC), S.Witness(source), m).defects == {"running-header"}


def test_rare_leftovers_are_no_known_words():
    """Three odd sources in many do not make a word."""
    assert "ach" in S.fit([(None, "еach ach", "a")] * 3).lexicon
    assert "ach" not in S.fit([(None, "each word", "a")] * 12_000 + [(None, "ach", "a")] * 3).lexicon
