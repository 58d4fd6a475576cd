"""Problem 4: where each sentence ends, in ten languages and seven scripts, in SQL expressions only.

Full stops that end nothing (decimals, dates, initials, abbreviations, addresses, marks in brackets) give way to
private-use characters, one for one, which in the text itself give way to others first; then a terminator pattern of the
language's script marks the ends and the text is split there. As the placeholders are as long as what they stand for,
the lengths of the pieces are the positions in the text itself, from which every sentence is restored by a
substring. Lines are seen together with the line that follows in their region, which decides whether a mark at a line's
end ends a sentence, and know whether a bracket is open where they begin. The only shuffle brings a sidebar's lines together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASK, CUT = "\ue000", "\ue001"
#: What stands for the placeholders where a text holds them itself; it is no letter, space or mark either.
NO_PLACEHOLDER = "\ufffd"

# Abbreviations that never end a sentence, and such that do where a capital follows.
NEVER_LAST = (
    "dr", "prof", "nr", "st", "ste", "mr", "mrs", "ms", "mme", "mlle", "mm", "capt", "gen", "lt", "cf", "vgl", "approx", "ca", "bzw", "ch", "chap", "bd", "vol", "fig", "abb", "p", "pp", "vs", "env",
    "n", "s", "m", "i", "j", "z", "d", "c", "e\\.g", "i\\.e", "u\\.a", "z\\.B", "d\\.h", "kap", "hr", "fr", "sog", "bes", "geb", "éd", "av", "apr", "π", "π\\.χ", "δηλ", "βλ", "κ", "σ", "δρ", "αγ", "د", "डॉ", "श्री",
)
HUNGARIAN_NEVER_LAST = ("özv", "ifj", "id", "ún", "ill", "ld", "pl", "kb", "vö", "kr", "sz", "szt", "gr", "fej", "old", "szerk", "ford", "hl")
# Marks that end no sentence inside brackets.
MARKS = ".!?…"
_GROUP = r"[(\[][^()\[\]]*+[)\]]"
# a mark behind an opening bracket or behind a mark that was masked before, whose bracket is closed again; from each bracket
# it is only looked to the next one, so that long texts take no longer
_INNER = rf"(\G(?!\A)[^()\[\]{MARKS}]*+|%s[^()\[\]{MARKS}]*+)[{MARKS}](?=[^()\[\]]*+[)\]])"
_OUTER = rf"(\G(?!\A)(?:[^()\[\]{MARKS}]|{_GROUP})*+|[(\[](?:[^()\[\]{MARKS}]|{_GROUP})*+)[{MARKS}](?=(?:[^()\[\]]|{_GROUP})*+[)\]])"
_NESTED = r"[(\[][^()\[\]]*+[(\[]"
# every pattern begins with the full stop itself, so that the look-behind is only tried there
_NUMBERED = r"\.(?<=\p{Nd}\.)(?=\s*\p{Nd})"
_SHORT = r"\.(?<=(?<![\p{L}\p{M}\p{Nd}])(?iu:%s)\.)"
_ABBREVIATED = _SHORT % "|".join(sorted(NEVER_LAST, key=len, reverse=True)) + r"|\.(?<=(?<!\p{L})No\.)(?=\s*\p{Nd})"
_HUNGARIAN = _SHORT % "|".join(sorted(HUNGARIAN_NEVER_LAST, key=len, reverse=True))
_ERA = r"\.(?<=\bKr[.\x{E000}]\s{0,2}[eu]\.)"
_TWO_LETTER = r"\.(?<=(?<!\p{L})[zduiec]\.)(?=[\s\x{A0}]?-?(?:B|h|a|e|g|à)\b)"
_INITIAL = r"\.(?<=(?<![\p{L}\p{M}\p{Nd}])\p{Lu}\.)(?=[\s-]*\p{Lu})"
_ADDRESS = r"\.(?<=[\p{L}\p{Nd}]\.)(?=[a-z]{2,}(?:[/.]|\b)(?![\p{Lu}]))"
_OPENERS = "„“”\"‚‘«»\\-–—(\\[¿¡"
_CASED_NEXT = rf"(?=\s*\z|\s+[{_OPENERS}]*\s*[^\p{{Ll}}\s{_OPENERS}]|[\p{{Lu}}„])"
# German words of the closed classes (articles, pronouns, prepositions, conjunctions, adverbs of place, time
# and manner), capitals only where a sentence begins; nouns are capitals there too.
GERMAN_STARTS = "|".join("""
Der Die Das Des Dem Den Ein Eine Einer Einem Einen Eines Kein Keine Dieser Diese Dieses Diesem Diesen Jener Jene Jenes Jeder Jede Jedes Alle Manche Viele Einige Beide
Ich Du Er Sie Es Wir Ihr Man Wer Was Wem Wen Mein Meine Dein Deine Sein Seine Unser Unsere Ihre Wo Wann Warum Wie Woher Wohin
In Im An Am Auf Aus Bei Beim Bis Durch Für Gegen Hinter Mit Nach Neben Ohne Seit Über Um Unter Von Vom Vor Während Wegen Trotz Zu Zum Zur Zwischen
Und Oder Aber Denn Doch Sondern Als Wenn Weil Da Dass Ob Obwohl Nachdem Bevor Damit Sobald Solange Falls Sofern
Dann Dort Hier Heute Gestern Jetzt Nun Noch Schon Oft Immer Bald Wieder Manchmal Endlich Zuletzt Vielleicht Auch Nur So Sehr Nicht Still Gern Langsam Zusammen
""".split())
_LATIN_END = r"([.!?…]+[”“\"»«’'\]]*)" + _CASED_NEXT
_GREEK_END = r"([.!?…;\x{037E}]+[”“\"»«’'\]]*)" + _CASED_NEXT
_FRENCH_END = r"([.!?…]+(?:[\s\x{A0}\x{202F}]?»|[”“\"’'\]])*)" + _CASED_NEXT
_GERMAN_ORDINAL = rf"\.(?<=\p{{Nd}}\.)(?=\s+\p{{Lu}})(?!\s+(?:{GERMAN_STARTS})\b)"
_BEFORE_NOUN = "der|die|das|dem|den|des|in|im|mit|unter|vor|neben|bei|hinter|von|zu|auf|aus|ein|eine|einer|einem"
_GERMAN_ELLIPSIS = rf"…(?<=\b(?:{_BEFORE_NOUN})\s?…)(?=\s+\p{{Lu}})"
_GERMAN_DOTS = rf"\.\.\.(?<=\b(?:{_BEFORE_NOUN})\s?\.\.\.)(?=\s+\p{{Lu}})"
_DEVANAGARI_END = "([।?!…]+)(?![।?!…”\"’])|([।?!…]+[”\"’]+)(?=\\s*\\z|\\s+[“\"‘])"
_ARABIC_END = "([.!?؟…]+)(?![.!?؟…»”\"’])(?=\\s|\\z)|([.!?؟…]+[»”\"’]+)(?=\\s*\\z|\\s+[«“\"‘])"
_CJK_END = "((?:[。！？]+|…+[。！？]+))(?!\\s*[”』」’。！？…])|((?:[。！？…]+)[”』」’]+)(?=\\s*\\z|\\s*[“『「‘])"
_CHINESE_END = "([。！？…]+)(?!\\s*[”』」’。！？…])|((?:[。！？…]+)[”』」’]+)(?=\\s*\\z|\\s*[“『「‘])"
_THAI_END = r"([!?…]+|(?<![\p{Nd}\sA-Za-zÀ-ɏ,.])(?=\s+[^\s\p{Nd}A-Za-zÀ-ɏ]))"


def _replaced(text: Column, *patterns: str) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, MASK)
    return text


def masked_brackets(text: Column, opened: Column) -> Column:
    """The text with the marks in brackets that are closed again masked, brackets in brackets included; `opened` tells
    whether a bracket is open where the text begins."""
    inner = F.when(opened, F.regexp_replace(text, _INNER % r"(?:\A|[(\[])", "$1" + MASK)).otherwise(F.regexp_replace(text, _INNER % r"[(\[]", "$1" + MASK))
    return F.when(text.rlike(_NESTED), F.regexp_replace(inner, _OUTER, "$1" + MASK)).when(text.rlike(r"[)\]]"), inner).otherwise(text)


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """`rows` with a column that is worked out once, however often later ones use it: a generator of one row keeps the
    steps before and after it apart."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def with_ends(rows: DataFrame, text: Column, lang: Column, opened: Column) -> DataFrame:
    """`rows` with `marked`: code points of `text` up to and with the last one of each sentence that a mark ends.

    The steps are columns of their own, so that no pattern is compiled into more than one branch."""
    both = "$1$2" + CUT
    stops = ("_own", "_bracketed", *(f"_masked{i}" for i in range(1, 4)))
    out = rows.withColumn("_lang", lang).withColumn("_own", F.translate(text, MASK + CUT, NO_PLACEHOLDER * 2))
    out = _once(out, "_bracketed", masked_brackets(F.col("_own"), opened))
    dotted = F.col("_bracketed").contains(".")
    out = out.withColumn("_masked1", F.when(dotted, _replaced(F.col("_bracketed"), _NUMBERED, _ABBREVIATED)).otherwise(F.col("_bracketed")))
    out = out.withColumn("_masked2", F.when(dotted, _replaced(F.col("_masked1"), _ERA, _TWO_LETTER, _INITIAL, _ADDRESS)).otherwise(F.col("_masked1")))
    hungarian = F.when(dotted, _replaced(F.col("_masked2"), _HUNGARIAN)).otherwise(F.col("_masked2"))
    german = F.regexp_replace(_replaced(F.col("_masked2"), _GERMAN_ORDINAL, _GERMAN_ELLIPSIS), _GERMAN_DOTS, MASK * 3)
    out = out.withColumn("_masked3", F.when(F.col("_lang") == "hun", hungarian).when(F.col("_lang") == "deu", german).otherwise(F.col("_masked2")))
    safe = F.col("_masked3")
    other = F.when(F.col("_lang") == "ell", F.regexp_replace(safe, _GREEK_END, "$1" + CUT))
    for code, pattern, kept in (("fra", _FRENCH_END, "$1" + CUT), ("hin", _DEVANAGARI_END, both), ("ara", _ARABIC_END, both), ("jpn", _CJK_END, both), ("zho", _CHINESE_END, both), ("tha", _THAI_END, "$1" + CUT)):
        other = other.when(F.col("_lang") == code, F.regexp_replace(safe, pattern, kept))
    out = out.withColumn("_cut", other.otherwise(F.regexp_replace(safe, _LATIN_END, "$1" + CUT)))
    out = out.withColumn("_sizes", F.transform(F.split("_cut", CUT), F.length))
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("ends"))
    # what follows the last cut ends by no mark
    sums = F.aggregate(F.slice("_sizes", 1, F.size("_sizes") - 1), start, lambda a, n: F.struct((a["n"] + n).alias("n"), F.array_append(a["ends"], a["n"] + n).alias("ends")), lambda a: a["ends"])
    return out.withColumn("marked", sums).drop(*stops, "_lang", "_cut", "_sizes")


def sentence_ends(rows: DataFrame) -> DataFrame:
    """(tbl, id, end_pos): one row per sentence end of `rows` (tbl, id, lang, text, following, opened).

    `following` is what comes after the text, null where nothing does, `opened` whether a bracket is open before it; a last
    sentence without a mark ends with a text of tbl 'item', and, in Thai, with the last line of a region. Null,
    empty and blank texts have no ends; an unknown or null language is read as Latin script; rows that occur twice count
    once."""
    return ends_of(rows.where("id is not null")).select("tbl", "id", F.explode("ends").alias("end_pos")).distinct()


def ends_of(rows: DataFrame) -> DataFrame:
    """`rows` that are not blank with `ends`, the positions of sentence ends in order."""
    whole = F.coalesce(F.concat(F.col("text"), F.lit("\n"), F.col("following")), F.col("text"))
    visible = F.length(F.regexp_replace("text", r"[\s\x{A0}\x{3000}\x{200B}]+\z", ""))
    made = rows.where("text is not null").withColumn("lang", F.coalesce("lang", F.lit("und"))).withColumn("visible", visible).where("visible > 0")
    made = with_ends(made, whole, F.col("lang"), F.coalesce("opened", F.lit(False)))
    marked = F.filter("marked", lambda e: e <= F.col("visible"))
    closes = (F.col("tbl") == "item") | ((F.col("lang") == "tha") & F.col("following").isNull())
    ends = F.array_distinct(F.concat(marked, F.when(closes, F.array("visible")).otherwise(F.array().cast("array<int>"))))
    return made.withColumn("ends", ends).drop("marked")


def sidebar_lines(lines: DataFrame, regions: DataFrame, books: DataFrame) -> DataFrame:
    """(tbl, id, lang, text, following, opened, region_id, line_no) of the lines in regions of kind sidebar, each line once."""
    sidebars = regions.where("region_id is not null").groupBy("region_id").agg(F.min("kind").alias("kind")).where("kind = 'sidebar'").select("region_id")
    kept = lines.select("line_id", "region_id", "book", "line_no", "text", "read_at").join(sidebars, "region_id")
    once = kept.groupBy("region_id", "line_id").agg(F.max_by(F.struct("book", "line_no", "text"), F.struct("read_at", "text")).alias("line")).select("region_id", "line_id", "line.*")
    order = Window.partitionBy("region_id").orderBy(F.col("line_no").asc_nulls_last(), "line_id")
    langs = books.where("book is not null").groupBy("book").agg(F.min("lang").alias("lang"))
    opened = F.coalesce(F.lag("text").over(order).rlike(r"[(\[][^)\]]*\z"), F.lit(False))
    seen = once.withColumn("following", F.lead("text").over(order)).withColumn("opened", opened)
    return seen.join(langs, "book", "left").select(F.lit("line").alias("tbl"), F.col("line_id").alias("id"), "lang", "text", "following", "opened", "region_id", "line_no")


def standalone_items(items: DataFrame, books: DataFrame) -> DataFrame:
    """(tbl, id, lang, text, following, opened, region_id, line_no) of the standalone paragraphs."""
    langs = books.where("book is not null").groupBy("book").agg(F.min("lang").alias("lang"))
    kept = items.where("type = 'para' and standalone").join(langs, "book", "left")
    nothing = (F.lit(None).cast("string").alias("following"), F.lit(False).alias("opened"), F.lit(None).cast("long").alias("region_id"), F.lit(None).cast("int").alias("line_no"))
    return kept.select(F.lit("item").alias("tbl"), F.col("item_id").alias("id"), "lang", "text", *nothing)


def sentence_units(rows: DataFrame) -> DataFrame:
    """(tbl, id, sentence_no, text): the sentences of each item, and of each sidebar (tbl 'region', id its region_id), over
    whose lines they go on; their texts make up the whole text but for white space at either end of each.

    Only the lines of one region are brought together. What follows the last end, in a sidebar whose last sentence has no
    mark, is a sentence too; texts without any visible character have none."""
    made = ends_of(rows)
    of_items = made.where("tbl = 'item' and id is not null").select("tbl", "id", "text", "ends")
    lines = made.where("tbl = 'line' and region_id is not null").groupBy("region_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("line_no", F.lit(2**31 - 1)).alias("line_no"), "id", "text", "ends"))).alias("l"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
    sums = F.aggregate("l", start, lambda a, x: F.struct((a["at"] + F.length(x["text"]) + 1).alias("at"), F.concat(a["ends"], F.transform(x["ends"], lambda e: (e + a["at"]).cast("int"))).alias("ends")), lambda a: a["ends"])
    of_regions = lines.select(F.lit("region").alias("tbl"), F.col("region_id").alias("id"), F.array_join(F.col("l.text"), "\n").alias("text"), sums.alias("ends"))
    both = of_items.unionByName(of_regions).withColumn("ends", F.array_distinct(F.array_append("ends", F.length("text"))))
    cut = F.transform("ends", lambda e, k: F.struct(F.when(k == 0, 0).otherwise(F.get(F.col("ends"), k - 1)).alias("a"), e.alias("b")))
    parts = F.filter(F.transform(cut, lambda c: F.regexp_replace(F.substring(F.col("text"), c["a"] + 1, c["b"] - c["a"]), r"^[\s\x{A0}\x{3000}\x{200B}]+|[\s\x{A0}\x{3000}\x{200B}]+\z", "")), lambda x: x != "")
    return both.select("tbl", "id", F.posexplode(parts).alias("sentence_no", "text"))
