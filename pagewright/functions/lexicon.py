"""Word lists: which words are known, what a checker reads as a word, and repair of confused vowels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vowels that are taken for each other, foreign accents of each class, and abbreviations that count as words.
CLASSES = ("aá", "eé", "ií", "oóöő", "uúüű")
FOREIGN = {"a": "àâäãāă", "e": "èêëēė", "i": "ìîïī", "o": "òôõōø", "u": "ùûūů", "y": "ýÿ"}
ABBREVIATIONS = ("stb", "ill", "max", "min", "pl", "kb", "vö", "ún", "db", "uo", "ld", "ford", "jav")

LETTER = r"[\p{L}\p{Nl}\p{No}]"
WORD = LETTER + "+"
TOKEN = r"[\p{L}\p{Nl}\p{No}]+(?:-[\p{L}\p{Nl}\p{No}]+)*"
SUFFIXED = rf"[\p{{Nd}}%°]-{TOKEN}|{TOKEN}"
LONGEST_SUFFIX = 6
MOST_CHANGES = 2

_FROM = "".join("".join(c) + FOREIGN.get(c[0], "") for c in CLASSES) + FOREIGN["y"]
_TO = "".join(c[0] * (len(c) + len(FOREIGN.get(c[0], ""))) for c in CLASSES) + "y" * len(FOREIGN["y"])


def skeleton(word: Column) -> Column:
    """The word with each vowel as the first of its class; two words can be taken for each other where these agree."""
    return F.translate(word, _FROM + _FROM.upper(), _TO + _TO.upper())


def checked_tokens(text: Column) -> Column:
    """Words to be checked, hyphenated ones as one: suffixes of numbers are left out, and so are parts under three
    letters; of a word that begins with an abbreviation in capitals only that counts."""
    raw = F.filter(F.regexp_extract_all(text, F.lit(SUFFIXED), F.lit(0)), lambda t: ~t.rlike(r"^[\p{Nd}%°]"))
    return F.filter(raw, lambda t: F.size(token_parts(t)) > 0)


def token_parts(token: Column) -> Column:
    parts = F.split(token, "-")
    head = parts[0]
    short = (F.upper(head) == head) & (F.lower(head) != head) & (F.length(head) <= 4)
    return F.filter(F.when(short, F.slice(parts, 1, 1)).otherwise(parts), lambda p: F.length(p) >= 3)


def known_words(lexicon: DataFrame) -> DataFrame:
    """(word): the distinct lower-case words of a list, with the abbreviations that always count."""
    extra = lexicon.sparkSession.createDataFrame([(w,) for w in ABBREVIATIONS], "word string")
    return lexicon.where("word is not null").select(F.lower("word").alias("word")).union(extra).distinct()


def with_book_words(words: DataFrame, book_words: DataFrame) -> DataFrame:
    """(book, word) of `words` (book, word) that a book's own list knows: equal, or a listed word of four letters or
    more with at most LONGEST_SUFFIX letters behind it. The prefix join is an equi-join on every possible length."""
    return _listed(words, book_words, ["book"])


def with_listed_words(words: DataFrame, listed: DataFrame) -> DataFrame:
    """(word) of `words` (word) that one list for all books knows, by the same rule."""
    return _listed(words, listed, [])


def _listed(words: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    own = listed.where("word is not null").select(*keys, F.lower("word").alias("listed")).distinct()
    lower = words.select(*keys, "word").distinct().withColumn("lower", F.lower("word"))
    prefix = F.explode(F.transform(F.sequence(F.greatest(F.lit(1), F.length("lower") - LONGEST_SUFFIX), F.length("lower")), lambda n: F.substring(F.col("lower"), F.lit(1), n)))
    tried = lower.where("lower <> ''").withColumn("listed", prefix)
    allowed = (F.length("listed") >= 4) | (F.col("listed") == F.col("lower"))
    return tried.where(allowed).join(own, [*keys, "listed"], "left_semi").select(*keys, "word").distinct()


def vowels_mended(texts: DataFrame, keys: list[str], lexicon: DataFrame) -> DataFrame:
    """`texts` (keys, text) with every word put right that vowel_repairs has a repair for. Words are looked up once each,
    however often they stand in the texts; a text's repairs come back as one small map."""
    words = texts.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("word"))
    repairs = vowel_repairs(words.select("word"), lexicon)
    of_text = words.join(repairs, "word").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("word", "fixed"))).alias("_fixes"))
    # the text as words and what stands between them, in turn
    pieces = F.split("text", rf"(?<={LETTER})(?!{LETTER})|(?<!{LETTER})(?={LETTER})")
    mended = F.array_join(F.transform(pieces, lambda w: F.coalesce(F.try_element_at("_fixes", w), w)), "")
    return texts.join(of_text, keys, "left").withColumn("text", F.when(F.col("_fixes").isNull(), F.col("text")).otherwise(mended)).drop("_fixes")


def vowel_repairs(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, fixed): unknown words of three letters or more that become exactly one known word when one vowel, or
    else two, is exchanged within its class. Ambiguous and known words have no row; nulls are left out."""
    known = lexicon.where("word is not null").select("word").distinct()
    unknown = words.where("word is not null").select("word").distinct().where(F.length("word") >= 3).join(known, "word", "left_anti")
    pairs = unknown.withColumn("s", skeleton(F.col("word"))).join(known.select(F.col("word").alias("fixed"), skeleton(F.col("word")).alias("s")), "s")
    letters = F.zip_with(F.split("word", ""), F.split("fixed", ""), lambda a, b: F.when(a == b, 0).otherwise(1))
    distance = F.aggregate(letters, F.lit(0), lambda a, b: a + b)
    legal = F.forall(F.zip_with(F.split("word", ""), F.split("fixed", ""), lambda a, b: (a == b) | F.lower(b).isin(*"".join(CLASSES), "y")), lambda x: x)
    near = pairs.withColumn("changes", distance).where((F.col("changes") <= MOST_CHANGES) & legal)
    least = near.groupBy("word").agg(F.min("changes").alias("changes"))
    return near.join(least, ["word", "changes"]).groupBy("word").agg(F.min("fixed").alias("fixed"), F.count("*").alias("n")).where("n = 1").select("word", "fixed")
