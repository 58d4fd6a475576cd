from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from pagewright.llm import glyphs
from pagewright.llm.p1_repeated import chunk_fingerprints, line_keys, repeated_lines, without_repeated_lines
from pagewright.llm.p2_lookalikes import consistent_text, disguised_terms
from pagewright.llm.p4_sentences import sentence_ends, sentence_units, sidebar_lines, standalone_items


def found(tables, texts, kinds=None, offset=3, pages=None):
    rows = [(i, "b", (pages or {}).get(i, i + 1), i, 0, t) for i, t in enumerate(texts)]
    regions = tables.regions([(i, "b", i + 1, 0, (kinds or {}).get(i, "text")) for i in range(len(texts))])
    return {r.line_id for r in repeated_lines(tables.lines(rows), regions, tables.books([("b", "hun", offset)])).collect()}


def test_repeated_lines_in_all_their_forms(tables):
    head = ["A tengeri út könyve", "A TENGERI ÚT KÖNYVE", "A tengeri út könyve | 6", "vii  A tengeri út könyve", "' A  tengeri út könyve -", "A te​ngeri út kö​nyve", "A t e n g e r i  ú t  k ö n y v e", "A tengeri út kőnyue"]
    assert found(tables, head) == set(range(8))
    assert found(tables, head[:5]) == set()
    assert found(tables, head[:5] * 2, pages={5: 1, 6: 2, 7: 3, 8: 4, 9: 5}) == set()


def test_other_numbers_are_content(tables):
    lines = [f"A tengeri út könyve {n}" for n in (50, 51, 52, 53, 54, 55, 56)]
    assert found(tables, lines) == set()
    assert found(tables, ["1. fejezet az útról"] * 7) == set(range(7))


def test_tables_short_lines_and_nulls(tables):
    assert found(tables, ["A tengeri út könyve"] * 7, kinds={0: "table", 1: "header"}) == set(range(1, 7))
    assert found(tables, ["rövid"] * 9) == set()
    assert found(tables, [None, "", " "] * 4) == set()
    assert found(tables, []) == set()
    assert found(tables, ["x" * 70_000] * 7) == set(range(7))


def test_chunks_tell_books_apart_and_follow_content():
    rows, _, _, salts, letters, sizes = line_keys(["gkmopsxzgkmopsxzgkmo", "gkmopsxzgkmopsxzgkmo", "gkmopsxzgkmopsxzgkmz"], np.ones(3, np.int64), np.array([1, 2, 1], np.uint64))
    whole, first, last, middle, bag = chunk_fingerprints(letters, sizes, salts)
    assert whole[0] != whole[1] and first[0] != first[1]
    assert first[0] == first[2] and whole[0] != whole[2] and list(sizes) == [20, 20, 20]


def keys(texts, pages=None):
    """Per text its keys: (number minus page or None, letters, salt)."""
    rows, moved, stated, salts, letters, sizes = line_keys(texts, np.array(pages or [1] * len(texts)), np.zeros(len(texts), np.uint64))
    text, ends = letters.astype(np.uint32).tobytes().decode("utf-32-le"), np.cumsum(sizes)
    out = [[] for _ in texts]
    for i, m, k, salt, n, end in zip(rows, moved, stated, salts, sizes, ends):
        out[i].append((int(m) if k else None, text[end - n : end], int(salt)))
    return out


def test_keys_of_lines():
    plain, numbered, roman, spread, longer, short, empty = keys(["A tengeri út könyve", "A tengeri út könyve | 6", "vii  A tengeri út könyve", "A t e n g e r i  ú t  k ö n y v e", "A tengeri út 12 könyve 5", "rövid", ""])
    assert len(plain) == len(spread) == 1 and plain == spread and short == empty == []
    assert numbered[1][0] == 5 and numbered[1][1:] == plain[0][1:] and numbered[0][2] != 0
    assert roman[1][0] == 6 and roman[1][1:] == plain[0][1:]
    assert len(longer) == 2 and longer[1][2] != 0 and longer[0][2] != longer[1][2]
    pairs = keys(["a carnival", "a camival x", "rnrnrniiiiiabc", "mmmuuiabcabc"])
    assert pairs[0][0][1] + "x" == pairs[1][0][1] and pairs[2][0][1] + pairs[3][0][1][-3:] == pairs[3][0][1]
    assert keys(["1999 2000 2001 2002 2003 ab"]) == [[]]


def test_the_same_letters_in_another_order_are_another_line(tables):
    assert found(tables, ["The master of the stone east"] * 3 + ["The master of the notes seat"] * 3) == set()
    assert found(tables, ["The master of the stone east"] * 4 + ["The master of tbe stone cast"] * 3) == set(range(7))


def test_lines_of_items_and_pages_without_repeated_lines(tables):
    head = "A tengeri út könyve"
    own = ["", "a kutya futott", "szép öreg malom", "hideg tél jött", "vár és torony", "nagy erdő mély", "hosszú út porában", "könnyű szellő fúj"]
    rows = [(2 * i + k, "b", i, i, k, t) for i in range(1, 8) for k, t in enumerate([head, own[i]])]
    regions, books = tables.regions([(i, "b", i, 0, "text") for i in range(1, 8)]), tables.books([("b", "hun", 3)])
    items = tables.items([(1, "b", 9, f"A szép ku-\n{head} | 13\ntya", False), (2, "b", 9, head, False), (3, "b", 9, f"x\n{head}", True), (4, "b", 9, None, False)])
    made = repeated_lines(tables.lines(rows), regions, books, items=items).where("item").collect()
    assert [(r.line_id, r.region_id) for r in made] == [(1, 1)]
    pages = {r.page: (r.text, r.cut) for r in without_repeated_lines(tables.lines(rows), regions, books).collect()}
    assert pages == {i: (own[i], 1) for i in range(1, 8)}


def test_numerals():
    assert [glyphs.roman_value(x) for x in ("xvii", "iv", "iiii", "vx", "", "abc")] == [17, 4, None, None, None, None]
    assert all(glyphs.roman_value(glyphs.roman_numeral(n)) == n for n in range(1, 400))


TERMS = [(1, "Kocpisco Hexa"), (2, "Spáxrexi"), (3, "Spaxrexi"), (4, "Taffipisco"), (5, "Jaso-ócso"), (6, "Kocpisco")]


def terms_found(tables, texts, terms=TERMS):
    spark = tables.spark
    items = tables.items([(i, "b", 1, t, False) for i, t in enumerate(texts)])
    listed = spark.createDataFrame(terms, "term_id long, term string")
    return sorted((r.id, r.term_id) for r in disguised_terms(tables.lines([]), items.withColumn("tbl", F.lit(1)), listed).collect())


def test_disguised_terms(tables):
    texts = [
        "a Кocpisco Hexa áll", "a Kocpisco Hexa áll", "Spáxrexi", "Ｓpaxrexi", "Ta​ﬃpisco", "Jaso‐ócso", "Косрisco", "Kocpisco Hexa", "KOCPISCO HEXA", "Spaxrexit", "Taffipiscó",
        "xKоcpisco", "Kоcpisco-ócso", None, "",
    ]
    assert terms_found(tables, texts) == [(0, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6)]
    assert terms_found(tables, texts, []) == [] and terms_found(tables, []) == []


def test_consistent_text_keeps_other_scripts(tables):
    spark = tables.spark
    rows = spark.createDataFrame([("item", 1, "Ο κήπος Кocpisco"), ("item", 2, "plain"), ("item", 3, None)], "tbl string, id long, text string")
    made = {r.id: r.text for r in consistent_text(rows, spark.createDataFrame(TERMS, "term_id long, term string")).collect()}
    assert made == {1: "Ο κήπος Kocpisco", 2: "plain", 3: None}


def consistent(tables, texts, vocabulary=(), copies=1, terms=TERMS):
    spark = tables.spark
    rows = spark.createDataFrame([("item", i + 1000 * k, t) for k in range(copies) for i, t in enumerate(texts)], "tbl string, id long, text string")
    lexicon = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    made = {r.id: r.text for r in consistent_text(rows, spark.createDataFrame(terms, "term_id long, term string"), lexicon).collect()}
    return [made[i] for i in range(len(texts))]


def test_mixed_tokens_take_their_dominant_script(tables):
    mixed = ["το λόγoς", "нeбо", "Λόγoς", "нeба", "Kиcло", "a\u0581 b"]
    assert consistent(tables, mixed, ["λόγος", "небо"]) == ["το λόγος", "небо", "Λόγος", "нeба", "Kиcло", "a\u0581 b"]
    # the vocabulary is also the corpus: words that stand there three times in one script
    corpus = ["небо и небо", "небо", "нeбо"]
    assert consistent(tables, corpus)[2] == "небо" and consistent(tables, corpus[1:])[1] == "нeбо"
    # words wholly in another script stay, but for terms
    assert consistent(tables, ["сосна сос", "Косрisco"], ["coc"]) == ["сосна сос", "Kocpisco"]


def test_one_form_for_every_look(tables):
    texts = ["ｶﾞｷﾞ", "\u212aelvin", "𝐀𝐛 szó", "ﬃ", "szó！", "語！", "e\u0301 a\u0308", "ตำ", "x² ½ …", "a\u200bb\u00a0c", "plain"]
    assert consistent(tables, texts) == ["ガギ", "Kelvin", "Ab szó", "ffi", "szó!", "語！", "é ä", "ตำ", "x² ½ …", "ab c", "plain"]


def ends(tables, texts):
    """texts: (lang, text with | at each sentence end)"""
    items = tables.items([(i, lang, 1, t and t.replace("|", ""), True) for i, (lang, t) in enumerate(texts)])
    books = tables.books([(lang, lang, 0) for lang in {lang for lang, _ in texts}])
    made = sentence_ends(standalone_items(items, books)).collect()
    return {i: sorted(r.end_pos for r in made if r.id == i) for i in range(len(texts))}


def wanted(text):
    parts = (text or "").split("|")[:-1]
    return [sum(map(len, parts[: k + 1])) for k in range(len(parts))]


SENTENCES = [
    ("hun", "Az öreg dr. Kovács áll.| Kb. 3,5 mérföld, ill. 1. fejezet.| A vége"[:-7] + "A vége|"), ("hun", "– Jössz? – kérdezte Anna.| – Jövök!|"), ("hun", "„Itt a vár!” – szólt.| Kr. e. 52. 10. 12. napján (vö. 12. old.) jött.|"),
    ("hun", "A régi… út, stb.| A szép (Kovács mester!) ház.| Vége?!|"), ("eng", "St. Anne said: “It is e.g. 5 p.m.” Then|"[:-6] + "|"), ("eng", "“Go!” said A. Smith.| He went…| The (cf. p. 12) end|"),
    ("deu", "Im 15. Jahrhundert war z. B. das Tor zu.| „Geh!“, sagte er.| In der… Stadt|"), ("fra", "« Où ? » dit M. Petit.| Il va c.-à-d. là.|"), ("ell", "Πού πάει;| Στον κήπο, π.χ. εδώ· ναι.|"),
    ("hin", "“वह कहाँ है?” राजा ने कहा।| लगभग 4.5 कोस।|"), ("ara", "«أين؟» قال الحارس.| نحو 4.5 ميلا!|"), ("jpn", "「来た？」と彼は言った。|村で、狼は走った……。|約4.5里|"), ("zho", "“来了？”商人说。|他走了……|走了4.5里！|"),
    ("tha", "พระราชาเดิน 36.8 ไมล์แล้ว| ช่างเหล็กพูด|"), ("hun", ""), ("hun", None), ("xxx", "One.| Two|"),
]


def test_sentences(tables):
    got = ends(tables, SENTENCES)
    for i, (lang, text) in enumerate(SENTENCES):
        assert got[i] == wanted(text), (lang, text, got[i])


MORE_SENTENCES = [
    ("eng", "A (very " + "long " * 30 + "bracket. And more) text.| Next|"), ("eng", "It ends here.| 1) Then a list.|"), ("eng", "One (two (three.) four.) five.| Six|"), ("eng", "An \ue001odd\ue000 text.| Yes.|"),
    ("eng", "Never closed (so. Go.| On|".replace("so. ", "so.| ")), ("deu", "Am 3. Tag ging er.| Es war das Jahr 1850.| Obwohl es kalt war, blieb er|"), ("eng", "word " * 20_000 + "end.| X|"),
]


def test_brackets_placeholders_and_long_texts(tables):
    got = ends(tables, MORE_SENTENCES)
    for i, (lang, text) in enumerate(MORE_SENTENCES):
        assert got[i] == wanted(text), (lang, text[:200], got[i])


def test_sentence_units(tables):
    items = tables.items([(1, "b", 1, "Az öreg dr. Kovács áll. A vége", True), (2, "b", 1, None, True), (3, "b", 1, "  ", True)])
    lines = tables.lines([(1, "b", 1, 7, 0, "A régi dr."), (2, "b", 1, 7, 1, "Kovács (a mester. A"), (2, "b", 1, 7, 1, "Kovács (a mester. A"), (3, "b", 1, 7, 2, "régi! úr) jött. Nincs"), (4, "b", 1, 7, 3, "vége"), (5, "b", 1, 8, 0, "Más.")])
    regions, books = tables.regions([(7, "b", 1, 0, "sidebar"), (8, "b", 1, 1, "text")]), tables.books([("b", "hun", 0)])
    made = sentence_units(standalone_items(items, books).unionByName(sidebar_lines(lines, regions, books))).collect()
    got = sorted((r.tbl, r.id, r.sentence_no, r.text) for r in made)
    assert got[:2] == [("item", 1, 0, "Az öreg dr. Kovács áll."), ("item", 1, 1, "A vége")]
    assert [r[3] for r in got[2:]][-1] == "Nincs\nvége" and all(r[0] == "region" and r[1] == 7 for r in got[2:])


def test_line_ends_depend_on_the_next_line(tables):
    lines = tables.lines([(1, "b", 1, 1, 0, "A régi dr."), (2, "b", 1, 1, 1, "Kovács jött."), (2, "b", 1, 1, 1, "Kovács jött."), (3, "b", 1, 1, 2, "„Igen!”"), (4, "b", 1, 1, 3, "– szólt Anna."), (5, "b", 1, 2, 0, "Nem sáv."), (6, "b", 1, 1, 4, "Nincs vége")])
    regions = tables.regions([(1, "b", 1, 0, "sidebar"), (1, "b", 1, 0, "sidebar"), (2, "b", 1, 1, "text")])
    made = sentence_ends(sidebar_lines(lines, regions, tables.books([("b", "hun", 0)]))).collect()
    assert sorted((r.id, r.end_pos) for r in made) == [(2, 12), (4, 13)]


def test_found_does_not_depend_on_order(tables):
    texts = ["A tengeri út könyve"] * 4 + ["A tengeri ut könyve"] * 3 + ["valami egészen más sor"]
    random.Random(3).shuffle(texts)
    assert found(tables, texts) == {i for i, t in enumerate(texts) if "tengeri" in t}
