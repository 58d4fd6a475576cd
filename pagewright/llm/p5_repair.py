"""Problem 5: words cut at line ends, misread words and page furniture in scanned text, and the text without them.

The lines of a region, without its furniture, are one stream of characters, and their words are decoded jointly on a
lattice over it. Its nodes are the places between tokens; its edges, each with a cost, are: a token as it is, nothing for a
word of the lexicon and UNKNOWN for any other; a token as the word that fewest confusions lead to; two neighbouring
tokens merged into one word over what stands between them (nothing over a hyphen, little over a bare line end, more over
other signs, most over a space inside a line), with confusions or a doubled digraph if need be; a token split into two
words. As no edge costs less than nothing, a stretch of known words with spaces between is its own best path; only the
stretches round unknown words and line ends are searched (`Words.best`), the rest is array arithmetic on hashes of
words. Words that any mixture of confusions leads to share a key of strokes, so one look-up finds them all; those that
only share a folded shape are tried too. Where paragraphs begin is chosen by dynamic programming over lines.

Lines are brought together by region, for paragraphs once more by run of regions, and the same pass over them counts for
problem 3. What a text region leaves open at its ends goes on in a row per region and is decoded against the next text
region of the book. Which unknown words are misread, or two words run together, and which are right but missing in the
lexicon is told by counts over the whole corpus: a word that is not rare beside the word that it would be repaired to is
right.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .codes import CodeTable, Rolling, code_points, powers, spans
from .glyphs import FOLD, INVISIBLE, number_value
from .p1_repeated import repeated_lines
from .p3_quality import _int_lists, bad_texts, common_words, lang_numbers, prose_items, region_counts, text_counts
from .streams import UNSPACED, book_facts, region_blocks, region_lines
from .tables import checkpointed

LANGS = ("hun", "eng", "deu", "fra")
#: Most lexicon words that are sent to the executors; a longer list is refused.
MAX_LEXICON = 2_000_000
#: An unknown word that is at least so frequent, beside what it would be repaired to, is right.
RIGHT_SHARE = 0.04
MOST_EDITS = 3
#: What a paragraph's end costs behind a full line, and what is gained by it at any line.
FULL_COST, BREAK_GAIN = 6.0, 4.5
#: A text region of fewer lines has no length of a full line of its own.
FEW_LINES = 3
NO_TEXT = ("table", "title", "caption")
# one or two letters that a hyphen, an accent of its own or an invisible character ties to other letters are no word
_TIES = f"-‐‑\u0300-\u036f{INVISIBLE}"
_WORD = re.compile(rf"[^\W_]{{3,}}|(?<![^\W_])(?<![^\W_][{_TIES}])(?<![{_TIES}][{_TIES}])[^\W_]{{1,2}}(?![^\W_]|[\u0300-\u036f]|[{_TIES}]+[^\W_])")
_TIE = re.compile(f"[{_TIES}]")
_NUMERAL = re.compile("[IVX]{2}")
_ENDED = re.compile("[.!?…。！？।؟][\"'”’»“«)\\]」』]*$")
# Languages whose sentences have no mark at their end.
UNMARKED = ("tha",)
# What may stand behind a word at a line's end that goes on in the next line.
BEHIND = "-\u2010\u00ad\u00ac\u2013.,:; \u00a0"
_HYPHEN = re.compile("[-‐­¬]")
_NUMBER_ONLY = re.compile(r"[\W_]*(?:[0-9IlOoSB]+|[ivxlcdmIVXLCDM]+)[\W_]*")
#: Costs of the lattice's edges: an unknown word as it is; a hyphen at a line's end that stays; merging over a hyphen, a bare
#: line end, other signs and a space; a doubled digraph; confusions in a merged word; a token as two words.
UNKNOWN, HYPHEN_STAYS = 8.0, 4.0
OVER = {"hyphen": 0.0, "bare": 1.0, "signs": 3.0, "space": 6.0}
#: What merging costs more for each part that is a word by itself, without and with confusions in the whole.
PART_KNOWN = {"hyphen": (0.0, 0.0), "bare": (0.0, 6.0), "signs": (8.0, 8.0), "space": (0.0, 100.0)}
DIGRAPH_COST, INEXACT, SPLIT = 0.5, 1.0, 7.0
#: Fewest letters of a part that a token is split into.
SPLIT_PART = 3
# Hungarian letters of several characters, of which a hyphen doubles the first.
DIGRAPHS = ("dzs", "sz", "zs", "cs", "ny", "gy", "ty", "ly", "dz")
# Characters that scanners take for each other, each class by its first one, and pairs.
_DIGIT_SHAPES = str.maketrans("ilosb", "11058")
CLASSES = ("oöóőòôõ0aáàâä6", "lií1ìîïj|", "nuüúűùûñ", "ceéèêëæ", "hb8", "tf", "s5", "z2", "yvý", "gq9")
PAIRS = (("rn", "m"), ("cl", "d"), ("lc", "k"), ("ll", "h"), ("nn", "m"))
_PAIR_SET = {*PAIRS, ("ii", "u")}
_SHAPE = {ord(c): group[0] for group in CLASSES for c in group}
# Folded letters by their strokes, so that each pair and the letter it is taken for are drawn alike.
_STROKES = str.maketrans({"n": "ll", "r": "ll", "h": "ll", "m": "llll", "d": "cl", "k": "lc"})


def shape(word: str, drawn: str | None = None) -> str:
    """A lower-case word with everything that is misread for each other drawn alike; `drawn` are its letters, each by its class."""
    out = word.replace("ii", "u").translate(_SHAPE) if drawn is None or "ii" in word else drawn
    for pair, one in PAIRS:
        if pair in out:
            out = out.replace(pair, one)
    return out


def strokes(word: str) -> str:
    """A key that is the same for all lower-case words that any mixture of confusions turns into each other."""
    return word.translate(_SHAPE).translate(_STROKES)


def confusion_cost(seen: str, meant: str, most: int = MOST_EDITS) -> int:
    """How many confusions, single letters and pairs, turn one word into the other; most + 1 beyond or without any."""
    a, b = seen.translate(_SHAPE), meant.translate(_SHAPE)
    never = most + 1
    cost = [[never] * (len(b) + 1) for _ in range(len(a) + 1)]
    cost[0][0] = 0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            now = cost[i][j]
            if now > most:
                continue
            if i < len(a) and j < len(b) and a[i] == b[j]:
                cost[i + 1][j + 1] = min(cost[i + 1][j + 1], now + (seen[i] != meant[j]))
            for x, y, raw_x, raw_y, di, dj in ((a[i : i + 2], b[j : j + 1], seen[i : i + 2], meant[j : j + 1], 2, 1), (b[j : j + 2], a[i : i + 1], meant[j : j + 2], seen[i : i + 1], 1, 2)):
                if (raw_x, raw_y) in _PAIR_SET:
                    cost[i + di][j + dj] = min(cost[i + di][j + dj], now + 1)
                elif (x, y) in _PAIR_SET or raw_x == "ii" and y == "n":
                    cost[i + di][j + dj] = min(cost[i + di][j + dj], now + 2)
    return min(cost[-1][-1], never)


def edits(a: str, b: str, most: int = MOST_EDITS) -> int:
    """Edit distance, or most + 1 beyond it."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def cased(fixed: str, seen: str) -> str:
    """The word meant in the letter case of the text."""
    letters = [c for c in seen if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return fixed.upper()
    return fixed[0].upper() + fixed[1:] if letters and seen[0].isupper() else fixed


class Words:
    """The lexicon of a language, its words by shape, and what unknown words were meant to be."""

    def __init__(self, lang: str, words: set[str]):
        self.lang, self.words = lang, words
        self.by_shape: dict[str, list[str]] = {}
        self.by_strokes: dict[str, list[str]] = {}
        for word in sorted(words):
            self.by_shape.setdefault(shape(word), []).append(word)
            self.by_strokes.setdefault(strokes(word), []).append(word)
        self.meant: dict[str, str | None] = {}
        self.cut: dict[tuple[str, str, str], str | None] = {}
        self.halves: dict[str, str | None] = {}
        self.single: dict[str, tuple[str, str, str] | None] = {}

    def nearest(self, word: str) -> str | None:
        """The lexicon word that a lower-case word looks like, if one is nearest."""
        drawn = word.translate(_SHAPE)
        cost = {w: edits(word, w) for w in self.by_shape.get(shape(word, drawn), ())}
        for w in self.by_strokes.get(drawn.translate(_STROKES), ()):
            cost[w] = min(cost.get(w, MOST_EDITS + 1), confusion_cost(word, w))
        if not cost:
            return None
        found = sorted((n, w) for w, n in cost.items())
        if found[0][0] > min(MOST_EDITS, (len(word) + 1) // 2) or len(found) > 1 and found[1][0] == found[0][0]:
            return None
        return found[0][1]

    def repair(self, token: str) -> str | None:
        """The word meant by an unknown token of the text, in its letter case; None for known words, names and
        numbers."""
        if token in self.meant:
            return self.meant[token]
        lower, out = token.lower(), None
        if lower not in self.words and not _NUMERAL.fullmatch(token) and any(c.isalpha() for c in lower):
            near = self.nearest(lower)
            out = near and cased(near, token)
        if len(self.meant) < 1_000_000:
            self.meant[token] = out
        return out

    def confusions(self, seen: str, meant: str) -> float:
        """What so many confusions cost, less in longer words, in which they are less likely another word."""
        n = min(edits(seen, meant), confusion_cost(seen, meant))
        return n * UNKNOWN / max(len(seen), 1)

    def one_word(self, parts: tuple[str, ...], over: str) -> tuple[float, str | None]:
        """The cost of the edge that makes one word of one or two tokens, and the word; None where there is none."""
        if len(parts) == 1:
            token = parts[0]
            if token.lower() in self.words:
                return 0.0, token
            fixed = self.repair(token)
            return (UNKNOWN, token) if fixed is None else (self.confusions(token.lower(), fixed.lower()), fixed)
        left, right = parts
        l, r = left.lower(), right.lower()  # noqa: E741
        if not right[0].islower() and not (left.isupper() and right.isupper()):
            return UNKNOWN, None
        known = (l in self.words) + (r in self.words)
        exact, inexact = (OVER[over] + known * PART_KNOWN[over][k] for k in (0, 1))
        found = [(exact, l + r)] if l + r in self.words else []
        if not found and over == "hyphen":
            found = [(exact + DIGRAPH_COST, w) for w in self._digraphs(l, r) if w in self.words][:1]
        if not found:
            for whole in (l + r, *(self._digraphs(l, r) if over == "hyphen" else ())):
                near = self.nearest(whole)
                if near is not None:
                    found = [(inexact + INEXACT + self.confusions(whole, near), near)]
                    break
        return (found[0][0], cased(found[0][1], left + right)) if found else (UNKNOWN, None)

    def _digraphs(self, l: str, r: str) -> list[str]:  # noqa: E741
        """The words that come of a doubled digraph at a line's end."""
        return [l[: -len(d)] + d[0] + r for d in DIGRAPHS if l.endswith(d) and r.startswith(d) and len(l) > len(d)] if self.lang == "hun" else []

    def two_words(self, token: str) -> tuple[float, str] | None:
        """The edge that splits a token into two words of the lexicon."""
        low = token.lower()
        for k in range(SPLIT_PART, len(low) - SPLIT_PART + 1):
            if low[:k] in self.words and low[k:] in self.words:
                return SPLIT, f"{token[:k]} {token[k:]}"
        return None

    def best(self, tokens: tuple[str, ...], between: tuple[str, ...]) -> list[tuple[int, int, str]]:
        """The best path over a stretch of tokens with what stands between them: (first token, tokens, text) per edge. Of
        paths at one cost the one that changes less is taken."""
        n = len(tokens)
        cost: list[float] = [0.0] + [float("inf")] * n
        by: list[tuple[int, str] | None] = [None] * (n + 1)
        for i in range(n):
            stays = i + 1 < n and over_of(between[i]) == "hyphen"
            one, text = self.one_word(tokens[i : i + 1], "")
            if stays:  # before a hyphen stands a part of a word, which is not repaired by itself
                one, text = (0.0 if tokens[i].lower() in self.words else UNKNOWN) + HYPHEN_STAYS, tokens[i]
            edges = [(1, one, text)]
            if one >= UNKNOWN and not stays and (two := self.two_words(tokens[i])):
                edges.append((1, *two))
            if i + 1 < n:
                over = over_of(between[i])
                price, whole = self.one_word(tokens[i : i + 2], over)
                if whole is not None:
                    edges.append((2, price, whole))
            for span, price, text in edges:
                if cost[i] + price < cost[i + span]:
                    cost[i + span], by[i + span] = cost[i] + price, (i, text)
        out, at = [], n
        while at:
            i, text = by[at]
            out.append((i, at - i, text))
            at = i
        return out[::-1]

    def split(self, token: str) -> str | None:
        """The two words that an unknown token is, if its best path is to split it."""
        if token not in self.halves:
            if len(self.halves) >= 1_000_000:
                self.halves.clear()
            cost, text = self.one_word((token,), "")
            two = self.two_words(token) if cost >= UNKNOWN else None  # costs less than an unknown word
            text = two[1] if two else text
            self.halves[token] = text if " " in text else None
        return self.halves[token]

    def alone(self, token: str) -> tuple[str, str, str] | None:
        """The fault (fault, token, what was meant) of an unknown token that is in no word with its neighbours."""
        if token not in self.single:
            if len(self.single) >= 1_000_000:
                self.single.clear()
            if (fixed := self.repair(token)) is not None:
                self.single[token] = ("misread", token, fixed)
            else:
                self.single[token] = None if (fixed := self.split(token)) is None else ("split", token, fixed)
        return self.single[token]

    def joined(self, left: str, between: str, right: str) -> str | None:
        """The word that a line end cuts in two, or None where it stands between two words."""
        at = (left, between, right)
        if at not in self.cut:
            _, whole = self.one_word((left, right), over_of(between))
            path = self.best((left, right), (between,)) if whole is not None else ()  # without that edge both words stay
            if len(self.cut) >= 1_000_000:
                self.cut.clear()
            self.cut[at] = path[0][2] if len(path) == 1 else None
        return self.cut[at]


def over_of(between: str) -> str:
    """What kind of gap two tokens have between them: at a line's end by the signs that stand there."""
    if between == " ":
        return "space"
    if _HYPHEN.search(between):
        return "hyphen"
    return "bare" if between.strip() in ("", ".") else "signs"


def _char_row(char: str) -> tuple:
    lower = char.lower()
    return char.isalnum(), bool(_TIE.match(char)), "\u0300" <= char <= "\u036f", char in BEHIND, bool(_HYPHEN.match(char)), char.isdigit(), ord(lower) if len(lower) == 1 else ord(char)


_CHARS = CodeTable({"word": bool, "tie": bool, "accent": bool, "behind": bool, "hyphen": bool, "digit": bool, "lower": np.uint32}, _char_row)


@dataclass
class Tokens:
    """The words of lines: where they stand, their line, and hashes of them in lower case."""

    begin: np.ndarray
    end: np.ndarray
    line: np.ndarray
    hashes: np.ndarray
    rolled: Rolling


def tokens_of(codes: np.ndarray, lengths: np.ndarray) -> Tokens:
    """The same words that _WORD finds, of all lines at once."""
    _CHARS.meet(codes)
    word, tie = _CHARS["word"][codes], _CHARS["tie"][codes]
    begin, end = spans(word)
    short = np.flatnonzero(end - begin <= 2)
    if len(short):
        b, e = begin[short], end[short]
        one, two = np.maximum(b - 1, 0), np.maximum(b - 2, 0)
        tied = (b > 1) & tie[one] & (word[two] | tie[two]) | _CHARS["accent"][codes[e]]
        at = e.copy()
        while (on := tie[at]).any():
            at = np.where(on, at + 1, at)
        tied |= (at > e) & word[at]
        kept = np.ones(len(begin), bool)
        kept[short[tied]] = False
        begin, end = begin[kept], end[kept]
    line = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)[begin]
    rolled = Rolling(_CHARS["lower"][codes] + np.uint32(7))
    return Tokens(begin, end, line, rolled.of(begin, end), rolled)


def word_hash(word: str) -> int:
    """The hash that tokens_of gives a lower-case word."""
    values = np.array([ord(c) for c in word], np.uint64) + np.uint64(7)
    return int(Rolling(values).of(np.zeros(1, np.int64), np.array([len(word)]))[0])


class Lexicon:
    """The words of all languages, by language and as a sorted table of hashes."""

    def __init__(self, lexicon: dict[str, set[str]]):
        self.of = {lang: Words(lang, w) for lang, w in lexicon.items()}
        self.langs = sorted(lexicon)
        listed = [(word_hash(w) << 2 & 0xFFFFFFFFFFFFFFFF | k, lang, w) for k, lang in enumerate(self.langs) for w in sorted(lexicon[lang])]
        listed.sort()
        self.keys = np.array([x[0] for x in listed], np.uint64)
        self.words = [(lang, w) for _, lang, w in listed]
        self.counts = np.zeros(len(listed), np.int64)

    def find(self, hashes: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """The place of each word in the table, -1 for unknown ones and languages without a lexicon (-1)."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        sought = hashes << np.uint64(2) | np.maximum(lang, 0).astype(np.uint64)
        place = np.minimum(np.searchsorted(self.keys, sought), len(self.keys) - 1)
        return np.where((self.keys[place] == sought) & (lang >= 0), place, -1)

    def count_rows(self) -> list[dict]:
        """How often each word was met, and from now on from nothing."""
        rows = [{"kind": "count", "lang": self.words[k][0], "token": self.words[k][1], "n": int(self.counts[k])} for k in np.flatnonzero(self.counts)]
        self.counts[:] = 0
        return rows


_LEXICONS: dict[str, Lexicon] = {}


def loaded(name: str, lexicon: dict[str, set[str]]) -> Lexicon:
    """The lexicon, made once per Python worker."""
    if name not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[name] = Lexicon(lexicon)
    return _LEXICONS[name]


def _behind(codes: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each stretch of code points whether it holds nothing but BEHIND, and whether there is a hyphen up to where others
    begin. Stretches are short, so they are gone through together, sign by sign."""
    at, hyphen = begin.copy(), np.zeros(len(begin), bool)
    on = np.flatnonzero(at < stop)
    while len(on):
        on = on[_CHARS["behind"][codes[at[on]]]]
        hyphen[on] |= _CHARS["hyphen"][codes[at[on]]]
        at[on] += 1
        on = on[at[on] < stop[on]]
    return at == stop, hyphen


@dataclass
class Found:
    """Faults (line, fault, token, word) and, per stream with open ends, its head (line, token) and tail (line, token,
    what stands behind it)."""

    faults: list[tuple[int, str, str, str]]
    heads: dict[int, tuple[int, str]]
    tails: dict[int, tuple[int, str, str]]


def decode(whole: str, codes: np.ndarray, lengths: np.ndarray, stream: np.ndarray, lang: np.ndarray, open_ends: np.ndarray, lexicon: Lexicon) -> Found:
    """Decode the lines of `whole`, each with a line break behind it; `stream` numbers the streams that they are in, `lang` are
    the lines' languages (-1 for none that has a lexicon, whose lines are passed over), and of streams in `open_ends` the
    first and last word are left to the neighbours."""
    out = Found([], {}, {})
    t = tokens_of(codes, lengths)
    mine = lang[t.line] >= 0
    if not mine.any():
        return out
    begin, end, line, hashes = t.begin[mine], t.end[mine], t.line[mine], t.hashes[mine]
    place = lexicon.find(hashes, lang[line])
    known = place >= 0
    lexicon.counts += np.bincount(place[known], minlength=len(lexicon.counts))
    words = [lexicon.of[x] for x in lexicon.langs]
    left_out = np.zeros(len(begin), bool)  # tokens that are no misread words of their own

    # lines with words: their first and last one, and what stands behind that
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    last = np.concatenate([first[1:], [len(line)]]) - 1
    of_line, of_stream = line[first], stream[line[first]]
    line_begin = np.cumsum(lengths + 1) - lengths - 1
    starts = begin[first] == line_begin[of_line]
    stop = line_begin[of_line] + lengths[of_line]
    held, hyphen = _behind(codes, end[last], stop)
    numbers = np.flatnonzero(_CHARS["digit"][codes[begin[last]]])
    held[numbers] &= np.array([not whole[a:b].isdigit() for a, b in zip(begin[last[numbers]].tolist(), end[last[numbers]].tolist())], bool)
    opens = np.concatenate([[True], of_stream[1:] != of_stream[:-1]])
    closes = np.concatenate([opens[1:], [True]])
    ends_open = open_ends[of_stream]
    text = lambda k: whole[begin[k] : end[k]]
    behind = lambda i: whole[end[last[i]] : stop[i]]

    head = opens & ends_open & starts
    left_out[first[head]] = True
    for i in np.flatnonzero(head).tolist():
        out.heads[int(of_stream[i])] = (int(of_line[i]), text(first[i]))
    # line ends inside a stream: only those with a hyphen or an unknown word beside them have more than one path
    held &= ~(head & (first == last))
    inner = np.flatnonzero(held & ~closes)
    if len(inner):
        left, right = last[inner], first[inner + 1]
        left_out[left[hyphen[inner]]] = True
        for i, a, b in zip(*(x[starts[inner + 1] & (hyphen[inner] | ~known[left] | ~known[right])].tolist() for x in (inner, left, right))):
            if not held[i]:
                continue
            joined = words[lang[of_line[i]]].joined(text(a), behind(i), text(b))
            if joined is not None:
                out.faults.append((int(of_line[i]), "hyphen", text(a) + "|" + text(b), joined))
                left_out[a] = left_out[b] = True
                if first[i + 1] == last[i + 1]:
                    held[i + 1] = False  # all of the next line is in this word
    for i in np.flatnonzero(held & closes).tolist():
        if ends_open[i]:
            out.tails[int(of_stream[i])] = (int(of_line[i]), text(last[i]), behind(i))
            left_out[last[i]] = True
        elif hyphen[i]:
            left_out[last[i]] = True

    # inside lines: unknown words beside a word with which they are one, and such that are two words
    unknown = ~known & ~left_out
    pair = np.flatnonzero((line[1:] == line[:-1]) & (begin[1:] == end[:-1] + 1) & (codes[end[:-1]] == 32) & (unknown[1:] | unknown[:-1]) & ~left_out[1:] & ~left_out[:-1])
    if len(pair):
        power, _ = powers(int((end - begin).max()))
        with np.errstate(over="ignore"):
            both = hashes[pair] + hashes[pair + 1] * power[end[pair] - begin[pair]]
        taken = -1
        for k in pair[lexicon.find(both, lang[line[pair]]) >= 0].tolist():
            if k <= taken:
                continue
            path = words[lang[line[k]]].best((text(k), text(k + 1)), (" ",))
            if len(path) == 1:
                out.faults.append((int(line[k]), "merge", text(k) + "|" + text(k + 1), path[0][2]))
                left_out[k] = left_out[k + 1] = True
                taken = k + 1
    alone = np.flatnonzero(~known & ~left_out)
    for at, of_lang, a, b in zip(*(x.tolist() for x in (line[alone], lang[line[alone]], begin[alone], end[alone]))):
        if (fault := words[of_lang].alone(whole[a:b])) is not None:
            out.faults.append((at, *fault))
    return out


def _lexicons(lexicon: DataFrame) -> dict[str, set[str]]:
    rows = lexicon.where(F.col("lang").isin(*LANGS) & F.col("word").isNotNull()).select("lang", "word").limit(MAX_LEXICON + 1).collect()
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} words")
    out: dict[str, set[str]] = {lang: set() for lang in LANGS}
    for row in rows:
        out[row.lang].add(row.word.lower())
    return out


DECODED = "kind string, tbl string, id long, lang string, token string, fixed string, n long, book string, page int, ord int, region_id long, id2 long, token2 string, counts array<int>"
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
_FIELDS = {name: _TYPES[kind] for name, kind in (f.split() for f in DECODED.split(", "))}
#: Kinds of DECODED rows that are faults of words.
WORD_FAULTS = ("hyphen", "misread", "merge", "split")


def _rows(size: int, **columns) -> pa.RecordBatch:
    """DECODED rows with the columns that are given: lists, arrays, or one value for all rows."""

    def column(name: str, kind: pa.DataType) -> pa.Array:
        value = columns.get(name)
        if value is None or isinstance(value, str):
            return pa.array([value] * size, kind)
        return value if isinstance(value, pa.Array) else pa.array(value, kind)

    return pa.RecordBatch.from_arrays([column(*f) for f in _FIELDS.items()], names=list(_FIELDS))


def _count_rows(lexicon: Lexicon) -> pa.RecordBatch:
    rows = lexicon.count_rows()
    return _rows(len(rows), kind="count", lang=[r["lang"] for r in rows], token=[r["token"] for r in rows], n=[r["n"] for r in rows])


def stated_number(text: str) -> int | None:
    """The number that is all a line states, Arabic, also with a misread digit, or Roman; else None."""
    word = "".join(text.translate(FOLD).split())
    if any(c.isdigit() for c in word):
        word = word.translate(_DIGIT_SHAPES)
    return number_value(word)


def lines_of_one_word(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of the lines that hold a single run of letters and digits."""
    _CHARS.meet(codes)
    begin, _ = spans(_CHARS["word"][codes])
    line = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)[begin]
    return np.flatnonzero(np.bincount(line, minlength=len(lengths)) == 1)


def is_page_number(text: str, page: int | None, offset: int | None, after: int = 0) -> bool:
    """Whether a line only states its page's printed number, or that of one of the `after` pages behind it."""
    if page is None or offset is None or not _NUMBER_ONLY.fullmatch(text):
        return False
    value = stated_number(text)
    return value is not None and page + offset <= value <= page + offset + after


def _fault_rows(found: Found, tbl: str, ids: list[int], lang: list[str], regions: list[int] | None) -> pa.RecordBatch:
    at = [f[0] for f in found.faults]
    return _rows(len(at), kind=[f[1] for f in found.faults], tbl=tbl, id=[ids[k] for k in at], lang=[lang[k] for k in at], token=[f[2] for f in found.faults], fixed=[f[3] for f in found.faults], region_id=regions and [regions[k] for k in at])


def decoded_lines(streams: DataFrame, lexicon: dict[str, set[str]], name: str, common: np.ndarray, runs: bool = False) -> DataFrame:
    """DECODED rows of all regions: counts for problem 3, lines that state their page's number, faults, counts of words, and
    the open ends of text regions; with `runs` also what chains() needs of each text region."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(name, lexicon)
        known.count_rows()
        number = {lang: k for k, lang in enumerate(known.langs)}
        for block in region_blocks(source):
            whole, codes, lengths = code_points(block.texts)
            facts, region, ids = block.facts, block.region.tolist(), block.line_ids.tolist()
            stated = [k for k in lines_of_one_word(codes, lengths).tolist() if not block.out[k] and is_page_number(block.texts[k], facts["page"][region[k]], facts["offset"][region[k]])]
            yield _rows(len(stated), kind="furniture", tbl="line", id=[ids[k] for k in stated], fixed="", region_id=[facts["region_id"][region[k]] for k in stated])
            block.out[stated] = True
            wanted, counts = region_counts(block, codes, lengths, common)
            yield _rows(len(wanted), kind="counted", tbl="region", id=[facts["region_id"][k] for k in wanted], lang=[facts["lang"][k] or "und" for k in wanted], counts=_int_lists(counts))
            is_text = np.array([k == "text" for k in facts["kind"]], bool)
            running = np.array([b is not None and k not in NO_TEXT for b, k in zip(facts["book"], facts["kind"])], bool)
            of_region = np.array([number.get(x, -1) for x in facts["lang"]])
            found = decode(whole, codes, lengths, block.region, np.where(running[block.region] & ~block.out, of_region[block.region], -1), is_text, known)
            line_lang = [facts["lang"][k] for k in region]
            yield _fault_rows(found, "line", ids, line_lang, [facts["region_id"][k] for k in region])
            shown = ~block.out & (lengths > 0)
            first = np.flatnonzero(shown & is_text[block.region] & running[block.region])
            open_ones = [k for k in np.unique(block.region[first]).tolist() if runs or of_region[k] >= 0]
            heads, tails = [found.heads.get(k, (None, None)) for k in open_ones], [found.tails.get(k, (None, None, None)) for k in open_ones]
            ends = np.concatenate([block.starts[1:], [len(region)]]) if len(region) else block.starts
            place = {c: [facts[c][k] for k in open_ones] for c in ("book", "page", "ord", "region_id", "lang")}
            of_run = None
            if runs:
                texts = [[block.texts[i] for i in range(block.starts[k], ends[k]) if shown[i]] for k in open_ones]
                of_run = pa.array([[int(begin_cost(t[0])), int(mark_cost(t[-1], lang)), len(t[-1]), usual_length(t), len(t)] for t, lang in zip(texts, place["lang"])], pa.list_(pa.int32()))
            yield _rows(len(open_ones), kind="ends", id=[ids[h[0]] if h[0] is not None else None for h in heads], token=[h[1] for h in heads], id2=[ids[t[0]] if t[0] is not None else None for t in tails], token2=[t[1] for t in tails], fixed=[t[2] for t in tails], counts=of_run, **place)
        yield _count_rows(known)

    return streams.mapInArrow(run, DECODED)


def decoded_items(items: DataFrame, books: DataFrame, heads: DataFrame, lexicon: dict[str, set[str]], name: str, common: np.ndarray) -> DataFrame:
    """DECODED rows of the paragraphs that are not standalone: counts for problem 3, faults, furniture, counts of words.
    `heads` (line_id, region_id) are items with the numbers of those of their lines that are repeated ones."""
    of_item = heads.groupBy(F.col("line_id").alias("id")).agg(F.collect_set("region_id").alias("heads"))  # no more than an item's lines
    full = prose_items(items, books).join(of_item, "id", "left")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(name, lexicon)
        known.count_rows()
        number = {lang: k for k, lang in enumerate(known.langs)}
        for batch in source:
            ids, pages, texts, langs, offsets, heads_ = (batch.column(c).to_pylist() for c in ("id", "page", "text", "lang", "offset", "heads"))
            whole, codes, lengths = code_points(texts)
            counts = text_counts(codes, lengths, common, lang_numbers(langs))
            yield _rows(len(ids), kind="counted", tbl="item", id=ids, lang=langs, counts=_int_lists(counts))
            stop = np.flatnonzero(codes == 10)  # every line has a break behind it
            sizes = np.diff(np.concatenate([[-1], stop])) - 1
            item = np.repeat(np.arange(len(ids)), lengths + 1)[stop]
            first = np.searchsorted(item, np.arange(len(ids)))
            out = np.zeros(len(stop), bool)
            for i, of in enumerate(heads_):
                out[[first[i] + k for k in of or ()]] = True
            several = np.bincount(item, minlength=len(ids)) > 1
            for k in lines_of_one_word(codes, sizes).tolist():
                i = item[k]
                if several[i] and is_page_number(whole[stop[k] - sizes[k] : stop[k]], pages[i], offsets[i], 2):
                    out[k] = True
            dirty = np.unique(item[out]).tolist()
            listed = [",".join(str(k - first[i]) for k in np.flatnonzero(out & (item == i)).tolist()) for i in dirty]
            yield _rows(len(dirty), kind="furniture", tbl="item", id=[ids[i] for i in dirty], token=listed, fixed="")
            of_lang = np.array([number.get(x, -1) for x in langs])
            found = decode(whole, codes, sizes, item, np.where(out, -1, of_lang[item]), np.zeros(len(ids), bool), known)
            of = item.tolist()
            yield _fault_rows(found, "item", [ids[i] for i in of], [langs[i] for i in of], None)
        yield _count_rows(known)

    return full.select("id", "page", "text", "lang", "offset", "heads").mapInArrow(run, DECODED)


_ENDS = ("book", "page", "lang", "id", "token", "id2", "token2", "fixed", "region_id")
_EDGES = ("book", "lang", "id", "token", "region_id", "id2", "token2", "fixed", "n")


def _met(words: Words, tail: tuple | None, head: tuple | None) -> list[tuple]:
    """Rows (kind, line, token, fixed, region) for what one region leaves open at its end, (line, token, what stands behind it,
    region), and the next one at its beginning, (line, token, region)."""
    if tail and head and (whole := words.joined(tail[1], tail[2] or "", head[1])) is not None:
        return [("hyphen", tail[0], tail[1] + "|" + head[1], whole, tail[3]), ("joined", head[0], None, None, head[2])]
    alone = [(tail[0], tail[1], tail[3])] if tail and not _HYPHEN.search(tail[2] or "") else []
    rows = []
    for at, token, region in alone + ([head] if head else []):
        if token.lower() not in words.words:
            if (fixed := words.repair(token)) is not None:
                rows.append(("misread", at, token, fixed, region))
            elif (fixed := words.split(token)) is not None:
                rows.append(("split", at, token, fixed, region))
    return rows


def _met_rows(rows: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
    """DECODED rows of _met, each behind its language, and of edges, the first and the last region of a page."""
    first, last = [e[0] for e in edges], [e[1] for e in edges]
    names = ("lang", "kind", "id", "token", "fixed", "region_id")
    at = dict(zip(names, map(list, zip(*rows)))) if rows else {c: [] for c in names}
    more = {"lang": [e[2] for e in first], "kind": ["edge"] * len(edges), "id": [e[3] for e in first], "token": [e[4] for e in first], "fixed": [e[7] for e in last], "region_id": [e[8] for e in first]}
    later = {"id2": [e[5] for e in last], "token2": [e[6] for e in last], "n": [e[8] for e in last], "book": [e[0] for e in first], "page": [e[1] for e in first]}
    return _rows(len(rows) + len(edges), tbl="line", **{c: at[c] + more[c] for c in names}, **{c: [None] * len(rows) + later[c] for c in later})


def _over_regions(ends: DataFrame, lexicon: dict[str, set[str]], name: str) -> DataFrame:
    """Faults at the ends of text regions: the tail of each with the head of the next text region of its page, or of the
    next page that has one. The region whose head is the end of a cut word has a row 'joined'. Regions are brought
    together by page; of each page a small row 'edge', with its first head and last tail, goes on by book."""

    def by_page(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(name, lexicon)
        first = before = None
        for batch in source:
            rows, edges = [], []
            for row in zip(*(batch.column(c).to_pylist() for c in _ENDS)):
                if before is not None and row[:2] == before[:2]:
                    if row[2] in known.of:
                        tail = before[5:] if before[6] else None
                        head = (row[3], row[4], row[8]) if row[4] else None
                        rows += [(row[2], *r) for r in _met(known.of[row[2]], tail, head)]
                else:
                    edges += [(first, before)] if first is not None else []
                    first = row
                before = row
            yield _met_rows(rows, edges)
        yield _met_rows([], [(first, before)] if first is not None else [])

    def by_book(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = loaded(name, lexicon)
        book = lang = tail = None

        def end() -> list[tuple]:
            return [(lang, *r) for r in _met(known.of[lang], tail, None)] if lang in known.of else []

        for batch in source:
            rows = []
            for this, of, head_id, head, head_region, tail_id, token, between, tail_region in zip(*(batch.column(c).to_pylist() for c in _EDGES)):
                if this != book:
                    rows += end()
                    book, tail = this, None
                lang = of
                if lang in known.of:
                    rows += [(lang, *r) for r in _met(known.of[lang], tail, (head_id, head, head_region) if head else None)]
                tail = (tail_id, token, between, tail_region) if token else None
            yield _met_rows(rows, [])
        yield _met_rows(end(), [])

    pages = ends.repartition("book", "page").sortWithinPartitions("book", "page", "ord", "region_id").select(*_ENDS)
    inside = checkpointed(pages.mapInArrow(by_page, DECODED))
    edges = inside.where("kind = 'edge'").repartition("book").sortWithinPartitions("book", "page").select(*_EDGES)
    return inside.where("kind <> 'edge'").unionByName(edges.mapInArrow(by_book, DECODED))


@dataclass
class Judged:
    """What is found in the whole corpus: furniture (line_id, region_id), regions and items (tbl, id) that are no prose,
    open ends of text regions, DECODED rows over them, and the faults that the counts bear out."""

    furniture: DataFrame
    bad: DataFrame
    ends: DataFrame
    over: DataFrame
    faults: DataFrame


def judged_faults(lines: DataFrame, regions: DataFrame, books: DataFrame, items: DataFrame, lexicon: DataFrame, form_labels: DataFrame, right_share: float, runs: bool = False) -> Judged:
    books = book_facts(books)
    repeated = checkpointed(repeated_lines(lines, regions, books.withColumnRenamed("offset", "page_number_offset"), items=items).select("item", "line_id", "region_id"))
    common = common_words(lines, items, books)
    known, name = _lexicons(lexicon), uuid.uuid4().hex
    streams = region_lines(lines, regions, books, repeated.where(~F.col("item")))
    decoded = checkpointed(decoded_lines(streams, known, name, common, runs).unionByName(decoded_items(items, books, repeated.where("item"), known, name, common)))
    bad = checkpointed(bad_texts(decoded.where("kind = 'counted'").select("tbl", "id", "lang", "counts"), form_labels))
    bad_regions = bad.where("tbl = 'region'").select(F.col("id").alias("region_id"))
    ends = decoded.where("kind = 'ends'").join(bad_regions, "region_id", "left_anti")
    over = _over_regions(ends, known, name)
    if runs:
        over = checkpointed(over)
    of = F.when(F.col("tbl") == "item", F.col("id")).otherwise(F.col("region_id"))
    here = decoded.where(F.col("kind").isin(*WORD_FAULTS, "furniture")).withColumn("_of", of).withColumn("_tbl", F.when(F.col("tbl") == "item", "item").otherwise("region"))
    here = here.join(bad.select(F.col("tbl").alias("_tbl"), F.col("id").alias("_of")), ["_tbl", "_of"], "left_anti")
    columns = ("tbl", "id", "region_id", F.col("kind").alias("fault"), "lang", "token", "fixed")
    seen = checkpointed(here.select(*columns).unionByName(over.where("kind <> 'joined'").select(*columns)))
    unsure = seen.where("fault in ('misread', 'split')").withColumn("low", F.lower("token")).withColumn("meant", F.lower("fixed"))
    counts = decoded.where("kind = 'count'").groupBy("lang", F.col("token").alias("meant")).agg(F.sum("n").alias("other"))
    tried = unsure.groupBy("lang", "low", "meant").agg(F.count("*").alias("own")).join(counts, ["lang", "meant"], "left")
    wrong = tried.where(F.col("own") <= F.greatest(F.lit(2.0), right_share * F.coalesce("other", F.lit(0)))).select("lang", "low", "meant")
    columns = ("tbl", "id", "region_id", "fault", "token", "fixed")
    faulty = unsure.join(wrong, ["lang", "low", "meant"], "left_semi").select(*columns)
    furniture = repeated.where(~F.col("item")).select("line_id", "region_id").unionByName(decoded.where("kind = 'furniture' and tbl = 'line'").select(F.col("id").alias("line_id"), "region_id"))
    return Judged(furniture, bad, ends, over, faulty.unionByName(seen.where("fault not in ('misread', 'split')").select(*columns)))


def faults(lines: DataFrame, regions: DataFrame, books: DataFrame, items: DataFrame, lexicon: DataFrame, form_labels: DataFrame, right_share: float = RIGHT_SHARE) -> DataFrame:
    """(tbl, id, fault, fixed), each once: words cut at line ends, misread words, and furniture.

    Lines and regions delivered twice count once. Regions and items that are no prose are left out; tables, titles
    and captions have furniture only, and so has text in languages without a lexicon. Null texts hold nothing."""
    made = judged_faults(lines, regions, books, items, lexicon, form_labels, right_share)
    bad_regions = made.bad.where("tbl = 'region'").select(F.col("id").alias("region_id"))
    of_lines = made.furniture.join(bad_regions, "region_id", "left_anti").select(F.lit("line").alias("tbl"), F.col("line_id").alias("id"), F.lit("furniture").alias("fault"), F.lit("").alias("fixed"))
    of_words = made.faults.where("fault in ('hyphen', 'misread') or fault = 'furniture' and tbl = 'item'").select("tbl", "id", "fault", "fixed")
    return of_words.unionByName(of_lines).distinct()


def usual_length(lines: list[str]) -> int:
    """The length that a full line of these has."""
    return sorted(map(len, lines))[(9 * len(lines)) // 10]


def mark_cost(line: str, lang: str | None = None) -> float:
    """What a paragraph's end behind a line costs for want of the mark of a sentence's end."""
    return 2.0 if lang in UNMARKED else 0.0 if _ENDED.search(line.rstrip()) else 4.0


def begin_cost(line: str) -> float:
    """What a paragraph's beginning with a line costs; letters without case tell nothing."""
    first = line.lstrip("„“«»–- \"")[:1]
    return 0.0 if first.isupper() or first.isalpha() and first.lower() == first.upper() else 2.0


def paragraph_starts(lines: list[str], usual: list[int] | None = None, whole: set[int] | frozenset[int] = frozenset(), lang: str | None = None) -> list[int]:
    """Where paragraphs begin, by dynamic programming: a break costs less behind a finished sentence and a short
    line, more inside a sentence, and paragraphs of a single line cost extra. `usual` is the length of a full line where
    each line stands; no paragraph begins at the lines of `whole`."""
    n = len(lines)
    if not n:
        return []
    usual = usual or [usual_length(lines)] * n
    cost = [0.0] + [mark_cost(a, lang) + begin_cost(b) + FULL_COST * min(1.0, len(a) / max(1, u)) - BREAK_GAIN + (1e6 if k in whole else 0.0) for k, (a, b, u) in enumerate(zip(lines, lines[1:], usual), 1)]
    # least cost up to line k with a paragraph beginning there, and with one going on, and the breaks so far, last first
    begun: tuple[float, tuple] = (0.0, (0, None))
    going: tuple[float, tuple] | None = None
    for k in range(1, n):
        breaks = [(begun[0] + cost[k] + 1.5, (k, begun[1]))]
        if going:
            breaks.append((going[0] + cost[k], (k, going[1])))
        going = min([begun] + ([going] if going else []), key=lambda o: o[0])
        begun = min(breaks, key=lambda o: o[0])
    at: tuple | None = min([begun] + ([going] if going else []), key=lambda o: o[0])[1]
    out = []
    while at:
        out.append(at[0])
        at = at[1]
    return out[::-1]


@dataclass
class Fixes:
    """Of a line: words with what was meant, cut words (left, right) with the whole, and words with a space in them."""

    words: dict[str, str]
    cut: dict[tuple[str, str], str]
    merged: dict[tuple[str, str], str]

    def mended(self, text: str) -> str:
        for (left, right), whole in self.merged.items():
            text = re.sub(rf"(?<![^\W_]){re.escape(left)} {re.escape(right)}(?![^\W_])", lambda _, w=whole: w, text)
        return _WORD.sub(lambda m: self.words.get(m.group(), m.group()), text) if self.words else text


def fixes_of(faults: list[tuple[str, str, str]]) -> Fixes:
    """`faults` are (fault, token, fixed)."""
    two = {kind: {tuple(token.split("|", 1)): fixed for fault, token, fixed in faults if fault == kind} for kind in ("hyphen", "merge")}
    return Fixes({token: fixed for fault, token, fixed in faults if fault in ("misread", "split")}, two["hyphen"], two["merge"])


def whole_paragraphs(texts: list[str], fixes: list[Fixes], usual: list[int] | None = None, lang: str | None = None) -> list[tuple[int, str]]:
    """The paragraphs of lines that run on, each with the place of the line in which it begins; cut words are whole and
    misread words right."""
    starts, ends, wholes = [0] * len(texts), [len(t) for t in texts], [""] * len(texts)
    inside: set[int] = set()
    held: tuple[int, str] | None = None  # the line before that has words, and its last word
    for k, text in enumerate(texts):
        tokens = _WORD.findall(text)
        if not tokens:
            continue
        if held is not None and text.startswith(tokens[0]) and (whole := fixes[held[0]].cut.get((held[1], tokens[0]))) is not None:
            ends[held[0]], wholes[held[0]], starts[k] = texts[held[0]].rindex(held[1]), whole, len(tokens[0])
            inside.update(range(held[0] + 1, k + 1))
        held = (k, tokens[-1]) if len(tokens) > 1 or not starts[k] else None
    breaks = set(paragraph_starts(texts, usual, inside, lang))
    out: list[tuple[int, list[str]]] = []
    for k, text in enumerate(texts):
        mended = fixes[k].mended(text[starts[k] : ends[k]]) + wholes[k]
        if k in breaks:
            out.append((k, [mended]))
        else:
            out[-1][1].append(mended if starts[k] or lang in UNSPACED else " " + mended)
    made = [(k, unicodedata.normalize("NFC", re.sub(r"\s+", " ", "".join(parts))).strip()) for k, parts in out]
    return [(k, text) for k, text in made if text]


def decoded_texts(lines: list[str], lexicon: Lexicon, lang: str, open_ends: bool = False) -> Found:
    """`decode` of the lines of one stream."""
    whole, codes, lengths = code_points(lines)
    n = len(lines)
    return decode(whole, codes, lengths, np.zeros(n, np.int64), np.full(n, lexicon.langs.index(lang)), np.array([open_ends]), lexicon)


def repaired_text(lines: list[str], lexicon: Lexicon, lang: str) -> list[str]:
    """The paragraphs of lines, with every fault that is decoded put right."""
    found = decoded_texts(lines, lexicon, lang).faults
    return [text for _, text in whole_paragraphs(lines, [fixes_of([f[1:] for f in found if f[0] == k]) for k in range(len(lines))], lang=lang)]


def chains(ends: DataFrame, over: DataFrame) -> DataFrame:
    """(region_id, chain, usual): each text region with the region in which the run of text begins that it goes on with,
    and the length of a full line, which short regions take from their page. A run ends where a paragraph does, so a region
    begins one if a break costs nothing there and no cut word spans it."""
    of_run = [F.get("counts", F.lit(i)).alias(c) for i, c in enumerate(("begins", "ends", "length", "usual", "lines"))]
    of_page = F.max("usual").over(Window.partitionBy("book", "page"))
    ends = ends.select("book", "page", "ord", "region_id", *of_run).withColumn("usual", F.when(F.col("lines") < FEW_LINES, of_page).otherwise(F.col("usual")))
    ends = ends.withColumn("ends", F.col("ends") + FULL_COST * F.least(F.lit(1.0), F.col("length") / F.greatest(F.lit(1), F.col("usual"))) - BREAK_GAIN)
    joined = over.where("kind = 'joined'").select("region_id", F.lit(True).alias("joined")).distinct()
    here = Window.partitionBy("book", "page").orderBy("ord", "region_id")
    placed = ends.join(joined, "region_id", "left").withColumn("before", F.lag("ends").over(here)).withColumn("at", F.row_number().over(here))
    by_page = Window.partitionBy("book").orderBy("page")  # a row per page
    pages = placed.groupBy("book", "page").agg(F.max_by("ends", "at").alias("ends"))
    placed = placed.join(pages.select("book", "page", F.lag("ends").over(by_page).alias("page_before")), ["book", "page"])
    before = F.when(F.col("at") == 1, F.col("page_before")).otherwise(F.col("before"))
    opens = F.col("joined").isNull() & (before.isNull() | (before + F.col("begins") < 0))
    opened = placed.withColumn("chain", F.last(F.when(opens, F.col("region_id")), ignorenulls=True).over(here))
    last = opened.groupBy("book", "page").agg(F.max_by("chain", "at").alias("last"))
    earlier = last.select("book", "page", F.last("last", ignorenulls=True).over(by_page.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    return opened.join(earlier, ["book", "page"]).select("region_id", F.coalesce("chain", "earlier").alias("chain"), "usual")


PARAGRAPHS = "book string, page int, region_id long, item_id long, par_no int, text string"
_PARAGRAPH_TYPES = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string())


def _paragraph_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_PARAGRAPH_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PARAGRAPH_TYPES)], names=[f.split()[0] for f in PARAGRAPHS.split(", ")])


def _fix_list(rows: list[dict] | None) -> Fixes:
    return fixes_of([(r["fault"], r["token"], r["fixed"]) for r in rows or ()])


def line_paragraphs(made: Judged, streams: DataFrame) -> DataFrame:
    """PARAGRAPHS of the streams of lines; a paragraph stands at the region in which it begins."""
    fixes = made.faults.where("tbl = 'line' and fault <> 'furniture'").groupBy("region_id").agg(F.collect_set(F.struct("id", "fault", "token", "fixed")).alias("fixes"))
    of_region = chains(made.ends, made.over).join(fixes, "region_id", "full_outer")
    text = streams.join(of_region, "region_id", "left").withColumn("fixes", F.expr("filter(fixes, f -> f.id = line_id)")).withColumn("chain", F.coalesce("chain", "region_id"))
    text = text.repartition("chain").sortWithinPartitions("chain", "page", "ord", "region_id", "line_no", "line_id")
    columns = ("chain", "region_id", "line_id", "book", "page", "lang", "text", "fixes", "usual")

    def of_chain(chain: list[dict]) -> list[tuple]:
        lengths: dict[int, list[str]] = {}
        for line in chain:
            lengths.setdefault(line["region_id"], []).append(line["text"])
        own = {region: usual_length(texts) for region, texts in lengths.items()}
        usual = [x["usual"] or own[x["region_id"]] for x in chain]
        begun: Counter = Counter()
        rows = []
        for k, paragraph in whole_paragraphs([x["text"] for x in chain], [_fix_list(x["fixes"]) for x in chain], usual, chain[0]["lang"]):
            region = chain[k]["region_id"]
            rows.append((chain[k]["book"], chain[k]["page"], region, None, begun[region], paragraph))
            begun[region] += 1
        return rows

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chain: list[dict] = []
        for batch in source:
            for line in batch.to_pylist():
                if chain and chain[-1]["chain"] != line["chain"]:
                    rows += of_chain(chain)
                    chain = []
                if line["text"] and not (chain and (chain[-1]["region_id"], chain[-1]["line_id"]) == (line["region_id"], line["line_id"])):
                    chain.append(line)
            if len(rows) > 5000:
                yield _paragraph_batch(rows)
                rows = []
        yield _paragraph_batch(rows + (of_chain(chain) if chain else []))

    return text.select(*columns).mapInArrow(run, PARAGRAPHS)


def item_paragraphs(made: Judged, items: DataFrame, books: DataFrame) -> DataFrame:
    """PARAGRAPHS of the items that are not standalone, each one paragraph."""
    fixes = made.faults.where("tbl = 'item'").groupBy("id").agg(F.collect_set(F.struct("fault", "token", "fixed")).alias("fixes"))
    bad = made.bad.where("tbl = 'item'").select("id")
    full = prose_items(items, books).join(bad, "id", "left_anti").join(fixes, "id", "left")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = []
            for item in batch.to_pylist():
                out = {int(k) for f in item["fixes"] or () if f["fault"] == "furniture" for k in f["token"].split(",")}
                texts = [line for k, line in enumerate(item["text"].split("\n")) if k not in out]
                made_ = whole_paragraphs(texts, [_fix_list(item["fixes"])] * len(texts), lang=item["lang"])
                glue = "" if item["lang"] in UNSPACED else " "
                if made_:
                    rows.append((item["book"], item["page"], None, item["id"], 0, glue.join(t for _, t in made_)))
            yield _paragraph_batch(rows)

    return full.select("id", "book", "page", "text", "lang", "fixes").mapInArrow(run, PARAGRAPHS)


def repaired_paragraphs(lines: DataFrame, regions: DataFrame, books: DataFrame, items: DataFrame, lexicon: DataFrame, form_labels: DataFrame, right_share: float = RIGHT_SHARE) -> DataFrame:
    """(book, page, region_id, item_id, par_no, text): the continuous paragraphs of lines, going on over text regions and
    pages, and of items, without furniture, in every language; words are repaired where p5_found has a fault."""
    made = judged_faults(lines, regions, books, items, lexicon, form_labels, right_share, runs=True)
    made.faults = checkpointed(made.faults)
    bad = made.bad.where("tbl = 'region'").select(F.col("id").alias("region_id"))
    streams = region_lines(lines, regions.join(bad, "region_id", "left_anti"), books, made.furniture).where("not out and book is not null").where(~F.coalesce(F.col("kind").isin(*NO_TEXT), F.lit(False)))
    return line_paragraphs(made, streams).unionByName(item_paragraphs(made, items, books))
