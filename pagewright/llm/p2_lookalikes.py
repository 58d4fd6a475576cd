"""Problem 2: text that looks the same in other characters.

Rows that hold nothing but characters of one form, in scripts without look-alikes, stay in the JVM and keep their text. The
others go through Arrow batches: widths, ligatures, single letters for letters, spaces, hyphens and accents take one
form and invisible characters go. In tokens that mix scripts the dominant script, the one with most of the letters, is
determined, and look-alikes of other scripts are replaced by its letters, if the word that comes out is in the
vocabulary: words that stand in the corpus in one script often enough, the lexicon, and the terms. Which of the forms that
mixed tokens could have are words of the corpus is counted first; only these forms are looked for. A word wholly in
another script is replaced by a term's only, as the terms' mentions must be found so too. Known terms are then found by
an Aho-Corasick automaton with word borders, the longest first.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .glyphs import INVISIBLE, LOOKALIKES

#: Most terms and vocabulary words that are sent to the executors; more are refused, not cut.
MAX_VOCABULARY = 2_000_000
#: How often a word must stand in the corpus, in one script, to be part of the vocabulary.
MIN_COUNT = 3
# Characters that have one form only and no look-alike in another script, as ranges in their order: those of
# ASCII, Latin letters with accents, Devanagari, Arabic, Thai and common CJK signs, and usual punctuation. Rows of only
# these are left as they are.
PLAIN = (
    ("\t", "\n"), ("\r", "\r"), (" ", "~"), ("¡", "§"), ("©", "©"), ("«", "«"), ("®", "®"), ("°", "±"), ("¶", "·"), ("»", "»"), ("¿", "\u0130"), ("Ń", "ň"), ("Ŋ", "ž"),
    ("Ə", "Ə"), ("Ơ", "ơ"), ("Ư", "ư"), ("\u060c", "\u061b"), ("\u061e", "\u066f"), ("\u0671", "\u0674"), ("\u0679", "\u06ff"), ("\u0900", "\u0957"), ("\u0960", "\u097f"),
    ("\u0e01", "\u0e5b"), ("–", "—"), ("‘", "‚"), ("“", "„"), ("†", "•"), ("…", "…"), ("‰", "‰"), ("‹", "›"), ("€", "€"), ("\u3001", "\u302d"), ("\u3041", "\u3096"), ("\u309d", "\u309e"),
    ("\u30a1", "\u30fe"), ("\u4e00", "\u9fff"),
)


def _span(first: str, last: str) -> str:
    return f"\\x{{{ord(first):x}}}-\\x{{{ord(last):x}}}"


def _nested(ranges: tuple[tuple[str, str], ...]) -> str:
    """What a character class of sorted ranges holds, halved again and again: Java tries the ranges of a class one by one, which
    took most of the time of all, but passes over a half that a character is not between the ends of."""
    if len(ranges) <= 2:
        return "".join(_span(*r) for r in ranges)
    mid = len(ranges) // 2
    return "".join(f"[{_span(half[0][0], half[-1][1])}&&[{_nested(half)}]]" for half in (ranges[:mid], ranges[mid:]))


#: Nothing but PLAIN; most characters are of ASCII, so those come first, by themselves.
PLAIN_ROW = rf"\A[\t\n\r -~[{_nested(PLAIN[3:])}]]*+\z"
HYPHENS = "‐‑‒−－﹣"
_INVISIBLE = frozenset(INVISIBLE)
# Wide punctuation that is right behind East Asian characters.
_WIDE = frozenset("：；？！，（）［］")
SCRIPTS = ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN")
# Armenian letters drawn as a Latin letter in common typefaces.
ARMENIAN = {"օ": "o", "ո": "n", "ս": "u", "հ": "h", "յ": "j", "ց": "g", "զ": "q", "Տ": "S", "Օ": "O", "Ս": "U", "Լ": "L"}
TO_LATIN = LOOKALIKES | ARMENIAN


def script_of(char: str) -> str:
    """Latin, Cyrillic, Greek or another script's name, by the character's name."""
    name = unicodedata.name(char, "?").split(" ")
    return "LATIN" if name[0] == "KELVIN" else name[0]


def _drawn_as() -> dict[str, dict[str, str]]:
    """Per script the letters of each look-alike group, by any letter of it."""
    groups: dict[str, list[str]] = {}
    for other, latin in TO_LATIN.items():
        groups.setdefault(latin, [latin]).append(other)
    out: dict[str, dict[str, str]] = {script: {} for script in SCRIPTS}
    for letters in groups.values():
        for script in SCRIPTS:
            own = [c for c in letters if script_of(c) == script]
            for c in letters if own else ():
                out[script].setdefault(c, c if c in own else own[0])
    return out


DRAWN_AS = _drawn_as()


@lru_cache(maxsize=20_000)
def form_of(char: str) -> str:
    """The consistent form of a visible character by itself: normal width, letters for ligatures and for letters in
    special styles, plain hyphens and spaces. Signs that look different stay."""
    if char in HYPHENS:
        return "-"
    if char.isspace() and char not in "\n\r":
        return " "
    tag = unicodedata.decomposition(char).split(" ")[0]
    made = unicodedata.normalize("NFKC", char)
    same_look = tag in ("<wide>", "<narrow>", "<font>", "<noBreak>") or tag == "<compat>" and unicodedata.category(char)[0] == "L" and made.isalpha()
    return made if same_look else unicodedata.normalize("NFC", char)


def _joins(char: str) -> bool:
    """Whether a character is an accent that belongs to the letter before it, also the sound marks of katakana."""
    return unicodedata.combining(char) > 0 or char in "ﾞﾟ"


def composed(text: str) -> tuple[list[str], list[int]]:
    """The visible characters in one consistent form and, for each, where it begins in `text`."""
    out: list[str] = []
    at: list[int] = []
    for i, char in enumerate(text):
        if "\x20" <= char < "\x7f":
            out.append(char)
            at.append(i)
        elif char in _INVISIBLE:
            continue
        elif out and _joins(char):
            accent = unicodedata.normalize("NFKC", char).strip()
            keep = unicodedata.normalize("NFC", out[-1] + accent)
            one = keep if len(keep) == 1 and out[-1] not in TO_LATIN else unicodedata.normalize("NFC", TO_LATIN.get(out[-1], out[-1]) + accent)
            if len(keep) == 1 or len(one) == 1:
                out[-1] = one if len(one) == 1 else keep
            else:
                out.append(accent)
                at.append(i)
        elif char in _WIDE and (not out or out[-1] >= "\u2e80"):
            out.append(char)
            at.append(i)
        else:
            for part in form_of(char):
                out.append(part)
                at.append(i)
    return out, at


def words_in(chars: list[str]) -> Iterator[tuple[int, int]]:
    """Where runs of letters and accents begin and end."""
    n, i = len(chars), 0
    while i < n:
        j = i
        while j < n and (chars[j].isalpha() or j > i and unicodedata.combining(chars[j])):
            j += 1
        if j > i:
            yield i, j
        i = max(j, i + 1)


def possible_forms(word: list[str]) -> list[str]:
    """What a token that mixes scripts can have been, in the order of likeliness: all of its letters in its dominant
    script. That is the one with most letters that are drawn alike in none of the others; where there are as many of each, or
    none, both are possible, that with more letters first. No form where the token is of one script, or where letters of
    other scripts have no look-alikes in the dominant one."""
    of = Counter(script_of(c) for c in word if c.isalpha())
    if len(of) < 2 or not of.keys() <= set(SCRIPTS):
        return []
    # a letter that is drawn alike in another of the scripts speaks for none
    sure = Counter(script_of(c) for c in word if c.isalpha() and not any(c in DRAWN_AS[s] for s in of if s != script_of(c)))
    most = max(sure.values(), default=0)
    ranked = sorted((s for s in of if sure[s] == most), key=lambda s: (-of[s], SCRIPTS.index(s)))
    made = ["".join(c if script_of(c) in (script, "COMBINING") else DRAWN_AS[script].get(c, "\0") for c in word) for script in ranked]
    return [m for m in made if "\0" not in m]


def repaired(chars: list[str], vocabulary: frozenset[str], names: frozenset[str] = frozenset()) -> list[str]:
    """The characters with look-alikes replaced in words of mixed script whose form in their dominant script is in the
    vocabulary, whatever the case of its letters, and in words wholly of another script that are then one of `names`."""
    out = list(chars)
    for i, j in words_in(chars):
        word = chars[i:j]
        if all(c < "\u0370" for c in word):
            continue
        forms = possible_forms(word)
        # a term's word comes first: disguised as a whole it can be frequent in another script, too
        fixed = next((f for f in forms if f in names), None) or next((f for f in forms if f in vocabulary or f.lower() in vocabulary), None)
        if fixed is None:
            latin = "".join(TO_LATIN.get(c, c) for c in word)
            fixed = latin if latin in names else None
        if fixed is not None:
            out[i:j] = list(fixed)
    return out


def _border(chars: list[str], at: int, step: int) -> bool:
    """Whether no word goes on at `at`: neither a letter or digit nor a hyphen with one behind it."""
    if not 0 <= at < len(chars):
        return True
    if chars[at].isalnum() or unicodedata.category(chars[at])[0] == "M":
        return False
    beyond = at + step
    return not (chars[at] == "-" and 0 <= beyond < len(chars) and chars[beyond].isalpha())


def _names(terms: list[tuple[int, str]]) -> frozenset[str]:
    """The words of the terms."""
    return frozenset(w for _, term in terms for w in re.split(r"[\W\d_]+", unicodedata.normalize("NFC", term)) if w)


def _finder(terms: list[tuple[int, str]], words: frozenset[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term_id, term in terms:
        form = unicodedata.normalize("NFC", term)
        automaton.add_word(form, (term_id, form, term))
    automaton.make_automaton()
    names = _names(terms)

    def find(text: str) -> tuple[str, list[int]]:
        chars, at = composed(text)
        chars = repaired(chars, words, names)
        joined = "".join(chars)
        hits = []
        for end, (term_id, form, term) in automaton.iter(joined) if terms else ():
            start = end - len(form) + 1
            if _border(chars, start - 1, -1) and _border(chars, end + 1, 1):
                hits.append((start, end, term_id, term))
        found, free_from = [], 0
        for start, end, term_id, term in sorted(hits, key=lambda h: (h[0], -h[1])):
            if start < free_from:
                continue
            free_from = end + 1
            until = at[end + 1] if end + 1 < len(at) else len(text)
            while until > at[end] + 1 and not _joins(text[until - 1]):
                until -= 1
            if text[at[start] : until] != term:
                found.append(term_id)
        return joined, sorted(set(found))

    return find


def corpus_words(rows: DataFrame, unusual: DataFrame, min_count: int = MIN_COUNT) -> list[str]:
    """Of the forms that the mixed tokens of `unusual` rows could have, in lower case, those that stand in `rows` in these
    very characters `min_count` times or more."""

    def forms(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found: set[str] = set()
            for text in batch.column("text").to_pylist():
                chars, _ = composed(text)
                if any(c >= "\u0370" for c in chars):
                    for i, j in words_in(chars):
                        found.update(f.lower() for f in possible_forms(chars[i:j]))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["word"])

    wanted = unusual.select("text").mapInArrow(forms, "word string").distinct().limit(MAX_VOCABULARY + 1).collect()
    if len(wanted) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} tokens of mixed script")
    if not wanted:
        return []
    listed = F.broadcast(rows.sparkSession.createDataFrame([(r.word,) for r in wanted], "word string"))  # no more than MAX_VOCABULARY
    words = rows.where("text is not null").select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{M}]+")).alias("word"))
    return [r.word for r in words.join(listed, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count).select("word").collect()]


def consistent_text(rows: DataFrame, terms: DataFrame, lexicon: DataFrame | None = None, min_count: int = MIN_COUNT) -> DataFrame:
    """(tbl, id, text, term_ids): the text of each row in one consistent form, and the terms that it shows in
    other characters than their own, null where there was nothing to change.

    `rows` has tbl, id and text; further columns are left out. Null or empty texts stay as they are; null and
    empty terms are ignored; of two equal terms the larger term_id is used. A vocabulary beyond MAX_VOCABULARY
    raises ValueError. Case and accents are kept, and so are terms that differ in an accent only."""
    listed = [(r[0], r[1]) for r in terms.select("term_id", "term").where("term is not null and term <> ''").orderBy("term_id").limit(MAX_VOCABULARY + 1).collect()]
    words = [r[0] for r in lexicon.select("word").where("word is not null").limit(MAX_VOCABULARY + 1).collect()] if lexicon is not None else []
    if max(len(listed), len(words)) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} terms or words")
    rows = rows.select("tbl", F.col("id").cast("long").alias("id"), "text")
    plain = F.coalesce(F.col("text").rlike(PLAIN_ROW), F.lit(True))
    unusual = rows.where(~plain)
    vocabulary = frozenset(w.lower() for w in words) | frozenset(corpus_words(rows, unusual, min_count))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(listed, vocabulary)
        for batch in source:
            made = [find(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tbl"), batch.column("id"), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.list_(pa.int64()))],
                names=["tbl", "id", "text", "term_ids"],
            )

    same = rows.where(plain).withColumn("term_ids", F.lit(None).cast("array<long>"))
    return same.unionByName(unusual.mapInArrow(batches, "tbl string, id long, text string, term_ids array<long>"))


def line_and_item_texts(lines: DataFrame, items: DataFrame) -> DataFrame:
    """(tbl, id, text) of recognised lines and assembled items."""
    return lines.select(F.lit("line").alias("tbl"), F.col("line_id").alias("id"), "text").unionByName(items.select(F.lit("item").alias("tbl"), F.col("item_id").alias("id"), "text"))


def disguised_terms(lines: DataFrame, items: DataFrame, terms: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(tbl, id, term_id), each once: the rows that show a term in other characters than its own."""
    made = consistent_text(line_and_item_texts(lines, items), terms, lexicon)
    return made.where("size(term_ids) > 0").select("tbl", "id", F.explode("term_ids").alias("term_id")).where("id is not null").distinct()
