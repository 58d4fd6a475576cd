"""What characters look like: folding of widths, accents, look-alike letters and misread shapes."""

from __future__ import annotations

import unicodedata

# Cyrillic and Greek letters drawn as a Latin letter in common typefaces.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "υ": "u", "κ": "k", "χ": "x", "γ": "y",
    "ı": "i", "ɡ": "g", "ɑ": "a",
}

# Characters without ink of their own.
INVISIBLE = "­͏؜ᅟ᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤﻿"

# Letter pairs and digits that scanners take for another letter, folded to one form.
PAIR_FOLDS = (("rn", "m"), ("cl", "d"), ("lc", "k"), ("li", "h"), ("ii", "u"), ("vv", "w"))
SHAPE_FOLDS = {"a": "o", "i": "l", "j": "l", "u": "n", "e": "c", "b": "h", "q": "g", "f": "t", "v": "y"}
DIGIT_FOLDS = {"0": "o", "1": "l", "2": "z", "5": "s", "6": "o", "8": "b", "9": "g"}


class Folding(dict):
    """str.translate table, filled on demand: lower case without accents, look-alikes as Latin letters,
    invisible characters gone, everything that is no letter, mark or digit a space."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if char in INVISIBLE:
            folded = ""
        else:
            folded = ""
            for part in unicodedata.normalize("NFKD", LOOKALIKES.get(char, char)):
                part = LOOKALIKES.get(part, part)
                if "̀" <= part <= "ͯ":
                    continue
                kind = unicodedata.category(part)
                if kind[0] in "LM":
                    folded += part.lower()
                elif kind == "Nd":
                    folded += str(unicodedata.digit(part))
                else:
                    folded += " "
        self[code] = folded
        return folded


FOLD = Folding()
SHAPES = str.maketrans(SHAPE_FOLDS)
DIGITS = str.maketrans(DIGIT_FOLDS)


def pair_key(word: str) -> str:
    """The word with letter pairs that scanners take for one letter as that letter, and digits beside letters as
    letters; single letters are folded by SHAPES."""
    if not word.isalpha() and not word.isdigit():
        word = word.translate(DIGITS)
    for pair, one in PAIR_FOLDS:
        if pair in word:
            word = word.replace(pair, one)
    return word


# Roman numerals by value.
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def roman_value(word: str) -> int | None:
    """Value of a well-formed lower-case Roman numeral, else None."""
    if not word or len(word) > 15 or not set(word) <= ROMAN.keys():
        return None
    total = 0
    for this, following in zip(word, [*word[1:], ""]):
        value = ROMAN[this]
        total += -value if following and ROMAN[following] > value else value
    return total if total and roman_numeral(total) == word else None


def roman_numeral(n: int) -> str:
    out = ""
    for value, letters in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= value:
            out, n = out + letters, n - value
    return out


def number_value(word: str) -> int | None:
    """Value of an Arabic or Roman page number of the folded text, else None."""
    if word.isdigit():
        return int(word) if len(word) < 9 else None
    return roman_value(word)
