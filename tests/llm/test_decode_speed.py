"""Decoding of lines: the same as plain versions, with no search where there is nothing to search for."""

from __future__ import annotations

import random

import numpy as np

from pagewright.llm import p1_repeated as p1
from pagewright.llm import p5_repair as p5
from pagewright.llm.codes import code_points

LISTED = {"eng": {"the", "stone", "garden", "smith", "old", "went", "home", "master"}}


def test_no_search_where_no_word_can_come_of_it(monkeypatch):
    searched = []
    search = p5.Words.best
    monkeypatch.setattr(p5.Words, "best", lambda self, tokens, between: searched.append(tokens) or search(self, tokens, between))
    lexicon = p5.Lexicon(LISTED)
    found = p5.decoded_texts(["the old Kocpis", "the gar-", "den xqvwz", "yqqkx thestone", "went hame"], lexicon, "eng").faults
    assert found == [(1, "hyphen", "gar|den", "garden"), (3, "split", "thestone", "the stone"), (4, "misread", "hame", "home")]
    assert searched == [("gar", "den")]


def test_joined_and_split_are_the_best_path():
    rng, words = random.Random(5), p5.Words("eng", LISTED["eng"])
    whole = sorted(LISTED["eng"])
    parts = [w[a:b] for w in whole for a in range(len(w)) for b in range(a + 1, len(w) + 1)] + ["Smith", "stnne", "THE", "thegarden", "rnaster", "xqvwz", "IV", "7"]
    for _ in range(3000):
        left, right, between = rng.choice(parts), rng.choice(parts), rng.choice(["", "-", "- ", ".", ",", "­"])
        path = words.best((left, right), (between,))
        assert words.joined(left, between, right) == (path[0][2] if len(path) == 1 else None), (left, between, right)
    for token in parts + [a + b for a in whole for b in whole]:
        text = words.best((token,), ())[0][2]
        assert words.split(token) == (text if " " in text else None), token


def test_what_stands_behind_words():
    rng = random.Random(6)
    texts = ["".join(rng.choice("a-,. )­") for _ in range(rng.randrange(7))) for _ in range(500)] + ["." * 5000, ""]
    whole, codes, lengths = code_points(texts)
    p5._CHARS.meet(codes)
    begin = np.cumsum(lengths + 1) - lengths - 1
    held, hyphen = p5._behind(codes, begin, begin + lengths)
    assert held.tolist() == [all(c in p5.BEHIND for c in t) for t in texts]
    assert [h for h, k in zip(hyphen.tolist(), held.tolist()) if k] == [bool(p5._HYPHEN.search(t)) for t, k in zip(texts, held.tolist()) if k]


def test_pairs_are_folded_as_in_strings():
    rng = random.Random(7)
    texts = ["".join(rng.choice("rnclivwa") for _ in range(rng.randrange(1, 12))) for _ in range(2000)]
    codes = np.array([ord(c) for t in texts for c in t], np.uint32)
    made, owner = p1.pair_folded(codes, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
    for k, text in enumerate(texts):
        for pair, one in p1.PAIR_FOLDS:
            text = text.replace(pair, one)
        assert "".join(map(chr, made[owner == k])) == "".join(p1.SHAPE_FOLDS.get(c, c) for c in text)
