"""Items into Markdown, and reports on what needs proofreading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from . import paragraphs as pg
from .lines import is_low_confidence, region_text

#: Regions of a page are so many items apart at most.
PER_REGION = 100_000


def heading_levels(items: DataFrame) -> DataFrame:
    """(book, seq, level) of the headings in a book's main text, by their glyph heights.

    Whole heights are put in clusters, a new one where a height is over 1.2 times the one before. Of two or three
    clusters the tallest is level 1; with fewer or more, and for headings without height, the level is 2."""
    heads = items.where("type = 'heading' and grp is null").select("book", "seq", "height", F.bround("height").cast("int").alias("h"))
    sizes = heads.where("height > 0").select("book", "h").distinct()
    order = Window.partitionBy("book").orderBy("h")
    before = F.lag("h").over(order)
    sizes = sizes.withColumn("_new", F.coalesce((F.col("h") / before > 1.2).cast("int"), F.lit(0))).withColumn("_c", F.sum("_new").over(order))
    sizes = sizes.withColumn("_most", F.max("_c").over(Window.partitionBy("book")))
    sizes = sizes.withColumn("level", F.when(F.col("_most").between(1, 2), F.col("_most") - F.col("_c") + 1).otherwise(2).cast("int"))
    return heads.join(sizes.select("book", "h", "level"), ["book", "h"], "left").select("book", "seq", F.when(F.col("height") > 0, F.coalesce("level", F.lit(2))).otherwise(2).alias("level"))


def markdown_blocks(items: DataFrame, markers: bool = True, keys: tuple[str, ...] = ("book",)) -> DataFrame:
    """(keys, block, text): each item as Markdown, neighbouring items of one group as one quotation, in order."""
    shown = items if markers else items.where("type <> 'marker'")
    label = F.when(F.col("printed").isNotNull() & (F.col("printed") != F.col("page")), F.format_string("page %d (pdf %d)", "printed", "page")).otherwise(F.format_string("page %d", "page"))
    text = (
        F.when(F.col("type") == "marker", F.concat(F.lit("<!-- "), label, F.lit(" -->")))
        .when((F.col("type") == "heading") & F.col("grp").isNotNull(), F.concat(F.lit("**"), "text", F.lit("**")))
        .when(F.col("type") == "heading", F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(2))), F.lit(" "), "text"))
        .when(F.col("type") == "caption", F.concat(F.lit("*"), "text", F.lit("*")))
        .otherwise(F.col("text"))
    )
    group = F.when(F.col("type") != "marker", F.col("grp"))
    order = Window.partitionBy(*keys).orderBy("seq")
    parts = shown.select(*keys, "seq", F.coalesce(text, F.lit("")).alias("t"), group.alias("g")).withColumn("_same", F.col("g").isNotNull() & F.col("g").eqNullSafe(F.lag("g").over(order)))
    parts = parts.withColumn("block", F.sum((~F.col("_same")).cast("int")).over(order).cast("int"))
    quoted = F.when(F.col("g").isNotNull(), F.concat(F.lit("> "), F.replace(F.col("t"), F.lit("\n"), F.lit("\n> ")))).otherwise(F.col("t"))
    ordered = F.sort_array(F.collect_list(F.struct("seq", quoted.alias("q"))))
    return parts.groupBy(*keys, "block").agg(F.array_join(ordered["q"], "\n>\n").alias("text"))


def render(items: DataFrame, markers: bool = True, keys: tuple[str, ...] = ("book",)) -> DataFrame:
    """(keys, markdown): the whole text of each book, or of each page where `keys` are book and page."""
    blocks = markdown_blocks(items, markers, keys)
    ordered = F.sort_array(F.collect_list(F.struct("block", "text")))
    return blocks.groupBy(*keys).agg(F.concat(F.trim(F.array_join(ordered["text"], "\n\n")), F.lit("\n")).alias("markdown"))


def page_markdown(items: DataFrame) -> DataFrame:
    """(book, page, markdown): each page by itself, with paragraphs that go on inside it joined."""
    return render(pg.merge_continuations(items, keys=("book", "page")), keys=("book", "page"))


def book_markdown(items: DataFrame, books: DataFrame) -> DataFrame:
    """(book, markdown): the whole book under its title, with paragraphs that go on over pages joined."""
    titles = books.where("book is not null").groupBy("book").agg(F.min("title").alias("title"))
    whole = render(pg.merge_continuations(items)).join(titles, "book", "left")
    return whole.select("book", F.concat(F.lit("# "), F.coalesce("title", "book"), F.lit("\n\n"), "markdown").alias("markdown"))


def page_items(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """(book, page, seq, type, text, grp, standalone) of the pages that have lines: paragraphs of text regions and
    sidebars (each a group of its own), titles as headings and captions as one text each, tables as their lines. Regions
    come in order of id; dropped ones and those without lines give nothing."""
    kept = regions.where("dropped is null").select("region_id", "book", "page", "id", "kind")
    of = lambda *kinds: kept.where(F.col("kind").isin(*kinds))
    running = pg.paragraphs(lines.join(of("text", "sidebar").select("region_id"), "region_id"), ["region_id"]).select("region_id", "par_no", "text")
    single = pg.single_line(lines.join(of("title", "caption").select("region_id"), "region_id"), ["region_id"]).select("region_id", F.lit(0).alias("par_no"), "text")
    tables = region_text(lines.join(of("table").select("region_id"), "region_id")).select("region_id", F.lit(0).alias("par_no"), "text")
    kind = F.when(F.col("kind") == "title", "heading").when(F.col("kind").isin("caption", "table"), F.col("kind")).otherwise("para")
    made = running.unionByName(single).unionByName(tables).join(kept, "region_id")
    grp = F.when(F.col("kind") == "sidebar", F.struct("page", F.col("id").alias("frame")))
    return made.select("book", "page", (F.col("id") * PER_REGION + F.col("par_no")).alias("seq"), kind.alias("type"), "text", grp.alias("grp"), F.lit(False).alias("standalone"))


def checked_texts(items: DataFrame) -> DataFrame:
    """(book, page, text) of items whose words are checked: those of a page that go on are joined first, markers and empty
    ones are left out."""
    columns = ("book", "page", "seq", "type", "text", "grp", "standalone")
    whole = pg.merge_continuations(items.select(*columns), keys=("book", "page"))
    return whole.where("type <> 'marker' and text is not null and text <> ''").select("book", "page", "text")


def page_quality(lines: DataFrame, texts: DataFrame, lexicon: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """(book, page, lines, low_conf_lines, words, unknown, unknown_ratio, unknown_words) per page.

    `lines` (book, page, conf) are counted as they are; `texts` (book, page, text) hold the words that are checked. Words
    are looked up once each, in the lexicon and then, by prefix, in the list `listed` (word) of words of the books'
    own. The ratio is 0 for a page without words; pages without lines have no row."""
    known = lx.known_words(lexicon)
    tokens = texts.select("book", "page", F.explode(lx.checked_tokens(F.col("text"))).alias("token")).groupBy("book", "page", "token").agg(F.count("*").alias("n"))
    parts = tokens.select("token").distinct().withColumn("word", F.explode(lx.token_parts(F.col("token")))).withColumn("word", F.lower("word"))
    unknown = parts.join(known, "word", "left_anti")
    if listed is not None:
        unknown = unknown.join(lx.with_listed_words(unknown.select("word"), listed), "word", "left_anti")
    judged = tokens.join(unknown.select("token").distinct().withColumn("_unknown", F.lit(1)), "token", "left")
    words = judged.groupBy("book", "page").agg(F.sum("n").alias("words"), F.sum(F.col("n") * F.coalesce("_unknown", F.lit(0))).alias("unknown"), F.array_sort(F.collect_set(F.when(F.col("_unknown") == 1, F.col("token")))).alias("unknown_words"))
    counted = lines.groupBy("book", "page").agg(F.count("*").alias("lines"), F.sum(is_low_confidence(F.col("conf")).cast("long")).alias("low_conf_lines"))
    out = counted.join(words, ["book", "page"], "left").fillna(0, ["words", "unknown"]).withColumn("unknown_words", F.coalesce("unknown_words", F.array().cast("array<string>")))
    return out.withColumn("unknown_ratio", F.round(F.coalesce(F.try_divide("unknown", "words"), F.lit(0.0)), 4))


def proofreading_order(quality: DataFrame) -> DataFrame:
    """`quality` with `rank`, 1 for the page of each book that needs proofreading most."""
    worst = Window.partitionBy("book").orderBy(F.desc("unknown_ratio"), F.desc("low_conf_lines"), "page")
    return quality.withColumn("rank", F.row_number().over(worst))


def frequent_unknown(quality: DataFrame, most: int = 80) -> DataFrame:
    """(book, word, pages, rank): the `most` unknown words of each book that are on most of its pages; of equal ones that
    which comes first, by page and then by word."""
    words = quality.select("book", "page", F.explode("unknown_words").alias("word")).groupBy("book", "word").agg(F.count("*").alias("pages"), F.min("page").alias("first_page"))
    order = Window.partitionBy("book").orderBy(F.desc("pages"), "first_page", "word")
    return words.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("book", "word", "pages", "rank")


def quality_markdown(quality: DataFrame, books: DataFrame, most: int = 80) -> DataFrame:
    """(book, report): for each book its title, a Markdown table of its pages, worst first, and its most frequent unknown
    words with their pages."""
    tenths = F.floor((F.round(F.col("unknown_ratio") * 10_000) + 5) / 10).cast("int")  # of a percent, halves up
    share = F.when(F.col("words") > 0, F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))).otherwise(F.lit("–"))
    row = F.format_string("| %d | %d | %d | %s |", "page", "lines", "low_conf_lines", share)
    pages = proofreading_order(quality).groupBy("book").agg(F.array_join(F.sort_array(F.collect_list(F.struct("rank", row.alias("row"))))["row"], "\n").alias("pages"))
    word = F.format_string("%s (%d)", "word", "pages")
    words = frequent_unknown(quality, most).groupBy("book").agg(F.array_join(F.sort_array(F.collect_list(F.struct("rank", word.alias("w"))))["w"], ", ").alias("words"))
    titles = books.where("book is not null").groupBy("book").agg(F.min("title").alias("title"))
    head = "\n\n| page | lines | low confidence | unknown words |\n| ---: | ---: | ---: | ---: |\n"
    full = pages.join(words, "book", "left").join(titles, "book", "left")
    below = F.coalesce(F.concat(F.lit("\n\nUnknown words: "), "words", F.lit("\n")), F.lit("\n"))
    return full.select("book", F.concat(F.lit("# "), F.coalesce("title", "book"), F.lit(head), "pages", below).alias("report"))
