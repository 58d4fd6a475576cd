"""Named queries of the core over the driver's tables, each with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as t
from ..operators import assemble, geometry as g, layout, lines as ln, ordering, paragraphs as pg, pixels, regions as rg
from ..sources import config, engines, pagejson
from ..streaming import pages as stream
from . import oracles

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
PAGE = ["book", "page"]


def query(make: Query) -> Query:
    _QUERIES[make.__name__] = make
    return make


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lines_of(spark: SparkSession, d: str) -> DataFrame:
    return ln.latest_lines(read(spark, d, "ocr_lines"))


def regions_of(spark: SparkSession, d: str) -> DataFrame:
    return rg.latest_regions(read(spark, d, "regions"))


def pages_of(spark: SparkSession, d: str) -> DataFrame:
    layouts, books = read(spark, d, "page_layouts"), read(spark, d, "books")
    return layouts.join(books.select("book", F.col("columns_n").alias("columns"), "first_page_side", "page_number_offset"), "book")


@query
def latest_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines_of(spark, d).select("line_id", "book", "page", "line_no", "text", "conf")


@query
def latest_regions(spark: SparkSession, d: str) -> DataFrame:
    return regions_of(spark, d).select("region_id", "book", "page", "id", "kind", "score")


@query
def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "ocr_lines").select("line_id", t.clean(F.col("text")).alias("text"))


@query
def line_predicates(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return read(spark, d, "ocr_lines").select("line_id", t.ends_sentence(text).alias("ends_sentence"), t.is_bullet(text).alias("is_bullet"), t.is_item(text).alias("is_item"))


@query
def region_text(spark: SparkSession, d: str) -> DataFrame:
    return ln.region_text(lines_of(spark, d))


@query
def geometry_ops(spark: SparkSession, d: str) -> DataFrame:
    layouts = read(spark, d, "page_layouts").select(*PAGE, "content")
    b, c = F.col("box"), F.col("content")
    both = regions_of(spark, d).join(layouts, PAGE)
    whole, union = g.rounded(b), g.union(b, c)
    return both.select(
        "region_id", g.width(b).alias("width"), g.height(b).alias("height"), g.area(b).alias("area"), g.centre_x(b).alias("cx"), g.centre_y(b).alias("cy"), g.area(g.intersection(b, c)).alias("common"),
        F.round(g.overlap_ratio(b, c), 6).alias("overlap"), union["x0"].alias("ux0"), union["y1"].alias("uy1"), whole["x0"].alias("ix0"), g.contains(c, g.centre_x(b), g.centre_y(b)).alias("inside"),
    )


@query
def content_box_parity(spark: SparkSession, d: str) -> DataFrame:
    pages = pages_of(spark, d).withColumn("side_by_page", g.side_of(F.col("page"), F.col("first_page_side")))
    made = g.content_box(F.col("width"), F.col("height"), F.col("side_by_page"))
    return pages.select(*PAGE, "side_by_page", g.printed_page(F.col("page"), F.col("page_number_offset")).alias("printed"), *(F.round(made[c], 3).alias(c) for c in ("x0", "y0", "x1", "y1")))


@query
def filter_marking(spark: SparkSession, d: str) -> DataFrame:
    regions = regions_of(spark, d).withColumn("dropped", F.lit(None).cast("string"))
    made = rg.filter_regions(regions, read(spark, d, "page_layouts"))
    return made.select("region_id", "dropped", F.col("box.x0").alias("x0"), F.col("box.y1").alias("y1"))


def _nested_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions with a copy of every seventh one shrunk into it and of every eleventh one twice, so that pages hold
    containers and duplicates."""
    base = regions_of(spark, d).select(*PAGE, "id", "kind", "box", F.lit(None).cast("string").alias("dropped"), "region_id")
    shift = lambda k: g.box(F.col("box.x0") + k, F.col("box.y0") + k, F.col("box.x1") - k, F.col("box.y1") - k)
    inner = base.where("region_id % 7 = 0").withColumn("box", shift(2)).withColumn("id", F.col("id") + 100)
    more = base.where("region_id % 77 = 0").withColumn("box", shift(3)).withColumn("id", F.col("id") + 200)
    return base.unionByName(inner).unionByName(more).drop("region_id")


@query
def dedupe_container(spark: SparkSession, d: str) -> DataFrame:
    return rg.containers(_nested_regions(spark, d))


@query
def dedupe_full(spark: SparkSession, d: str) -> DataFrame:
    return rg.dedupe(_nested_regions(spark, d)).select(*PAGE, "id", "dropped")


def _frames(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "page_layouts").select(*PAGE, F.posexplode("frames").alias("frame_id", "box"))


def _drawn_frames(spark: SparkSession, d: str, regions: DataFrame) -> DataFrame:
    drawn = g.box(F.col("box.x0") - 10, F.col("box.y0") - 10, F.col("box.x1") + 10, F.col("box.y1") + 10)
    round_sidebars = regions.where("kind = 'sidebar'").select(*PAGE, (F.col("id") + 100).alias("frame_id"), drawn.alias("box"))
    return _frames(spark, d).unionByName(round_sidebars)


@query
def frame_groups(spark: SparkSession, d: str) -> DataFrame:
    """Frames drawn round the sidebars, beside those of the layouts."""
    regions = regions_of(spark, d).withColumn("dropped", F.lit(None).cast("string"))
    return rg.frame_groups(regions, _drawn_frames(spark, d, regions))


def _two_columns(spark: SparkSession, d: str) -> DataFrame:
    """Regions set in two columns by the parity of their id, every fifth as a narrow note at the outer edge."""
    left = F.when(F.col("id") % 5 == 4, 1390).otherwise(F.when(F.col("id") % 2 == 0, 110).otherwise(790))
    wide = F.when(F.col("id") % 5 == 4, 180).otherwise(560)
    box = g.box(left, F.col("box.y0"), left + wide, F.col("box.y1"))
    return regions_of(spark, d).withColumn("box", box).withColumn("dropped", F.lit(None).cast("string"))


@query
def margin_notes(spark: SparkSession, d: str) -> DataFrame:
    return rg.margin_notes(_two_columns(spark, d), read(spark, d, "page_layouts"))


@query
def column_gutters(spark: SparkSession, d: str) -> DataFrame:
    boxes = _two_columns(spark, d).join(read(spark, d, "page_layouts").select(*PAGE, "content"), PAGE)
    made = ordering.gutters(boxes.select(*PAGE, "box", "content"), PAGE)
    return made.select(*PAGE, F.posexplode("bounds").alias("k", "x")).withColumn("x", F.round("x", 3))


@query
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return ordering.order_regions(regions_of(spark, d), pages_of(spark, d).select(*PAGE, "content", "columns"), _frames(spark, d), "page_end")


@query
def two_column_order(spark: SparkSession, d: str) -> DataFrame:
    pages = pages_of(spark, d).select(*PAGE, "content", F.lit(None).cast("int").alias("columns"))
    return ordering.order_regions(_two_columns(spark, d).withColumn("grp", F.lit(None).cast("int")), pages)


@query
def page_layout(spark: SparkSession, d: str) -> DataFrame:
    """All layout steps: what is dropped, what belongs together, the order in which it is read."""
    regions = regions_of(spark, d)
    made = layout.build_layout(regions, pages_of(spark, d), _drawn_frames(spark, d, regions), notes=True)
    return made.select(*PAGE, "id", "kind", "dropped", "grp", "ord")


@query
def label_kinds(spark: SparkSession, d: str) -> DataFrame:
    label = F.element_at(F.split("source", ":"), -1)
    return regions_of(spark, d).groupBy(label.alias("label"), rg.kind_of(label).alias("kind")).agg(F.count("*").alias("n"))


@query
def row_groups(spark: SparkSession, d: str) -> DataFrame:
    return ordering.group_rows(lines_of(spark, d).where("box is not null").select("region_id", F.col("line_no").alias("ordinal"), "box"), ["region_id"])


@query
def line_pairing(spark: SparkSession, d: str) -> DataFrame:
    lines = lines_of(spark, d).select("region_id", "line_no", "text", "box", "conf")
    lower = g.box(F.col("box.x0"), F.col("box.y0") + 1, F.col("box.x1"), F.col("box.y1") + 1)
    paired = ln.paired_lines(lines, lines.withColumn("box", lower), ["region_id"])
    return paired.select("region_id", "line_no", F.array_join("partners", " ").alias("partner_text"), F.size("partners").alias("n"))


def _words(spark: SparkSession, d: str) -> DataFrame:
    """Words of the lines with a confidence that follows from their place and length."""
    words = lines_of(spark, d).select("line_id", F.posexplode(F.split("text", " ")).alias("word_no", "word"))
    return words.withColumn("conf", ((F.col("word_no") * 37 + F.length("word") * 11) % 100 - 3).cast("double"))


@query
def word_filter(spark: SparkSession, d: str) -> DataFrame:
    return ln.kept_words(_words(spark, d))


@query
def edge_junk(spark: SparkSession, d: str) -> DataFrame:
    return ln.edge_trimmed(ln.kept_words(_words(spark, d)), ["line_id"]).select("line_id", "word_no", "word")


@query
def junk_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines_of(spark, d).select("line_id", ln.is_junk(F.filter(F.split("text", " "), lambda w: w != "")).alias("junk"))


@query
def word_lines(spark: SparkSession, d: str) -> DataFrame:
    """Words of each region put together again as their engine's post-processing does."""
    words = lines_of(spark, d).where("box is not null").select("region_id", F.col("par").alias("block"), F.lit(0).alias("par"), F.col("line_no").alias("line"), "box", F.posexplode(F.split("text", " ")).alias("k", "word"))
    words = words.withColumn("word_no", F.col("line") * 1000 + F.col("k")).withColumn("conf", F.lit(80.0) + F.col("k") % 3)
    return ln.word_lines(words, ["region_id"]).select("region_id", "line_no", "par", "text", "conf")


@query
def answer_lines(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "items").where("type = 'para'")
    return ln.answer_lines(items.select("item_id", F.replace("text", F.lit(". "), F.lit(".\n\n")).alias("answer")), ["item_id"])


def _text_lines(spark: SparkSession, d: str) -> DataFrame:
    regions = regions_of(spark, d).where("kind in ('text', 'sidebar')").select("region_id")
    return lines_of(spark, d).join(regions, "region_id").select("region_id", "line_no", "text", "box", "par")


@query
def paragraph_breaks_par(spark: SparkSession, d: str) -> DataFrame:
    lines = _text_lines(spark, d).withColumn("box", F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>"))
    return pg.paragraph_breaks(lines, ["region_id"]).select("region_id", "line_no", "breaks")


@query
def paragraph_breaks_geo(spark: SparkSession, d: str) -> DataFrame:
    return pg.paragraph_breaks(_text_lines(spark, d), ["region_id"]).select("region_id", "line_no", "breaks")


@query
def hanging_indent(spark: SparkSession, d: str) -> DataFrame:
    return pg.paragraph_breaks(_text_lines(spark, d), ["region_id"], hanging=True).select("region_id", "line_no", "breaks")


@query
def paragraphs_text(spark: SparkSession, d: str) -> DataFrame:
    return pg.paragraphs(_text_lines(spark, d), ["region_id"])


MAX_LEXICON = 1_000_000


def _known(spark: SparkSession, d: str) -> frozenset[str]:
    """The word list for joins in Arrow batches: a fixed list, refused beyond MAX_LEXICON words."""
    rows = lx.known_words(read(spark, d, "lexicon")).limit(MAX_LEXICON + 1).collect()
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} words")
    return frozenset(r.word for r in rows)


@query
def dehyphenate_lexicon(spark: SparkSession, d: str) -> DataFrame:
    return pg.paragraphs(_text_lines(spark, d), ["region_id"], known=_known(spark, d))


@query
def single_lines(spark: SparkSession, d: str) -> DataFrame:
    regions = regions_of(spark, d).where("kind in ('title', 'caption')").select("region_id")
    return pg.single_line(lines_of(spark, d).join(regions, "region_id"), ["region_id"])


@query
def continuation_islands(spark: SparkSession, d: str) -> DataFrame:
    return pg.continuation_islands(read(spark, d, "items")).select("item_id", "island")


@query
def merge_continuations(spark: SparkSession, d: str) -> DataFrame:
    return pg.merge_continuations(read(spark, d, "items")).select("item_id", "text")


@query
def heading_levels(spark: SparkSession, d: str) -> DataFrame:
    return assemble.heading_levels(read(spark, d, "items"))


@query
def render_markdown(spark: SparkSession, d: str) -> DataFrame:
    return assemble.render(read(spark, d, "items"))


@query
def page_markdown(spark: SparkSession, d: str) -> DataFrame:
    return assemble.page_markdown(read(spark, d, "items"))


@query
def book_markdown(spark: SparkSession, d: str) -> DataFrame:
    return assemble.book_markdown(read(spark, d, "items"), read(spark, d, "books"))


@query
def html_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "items").where("type = 'table'")
    cells = F.regexp_replace(F.regexp_replace("text", r" {2,}| ?\| ?", "</td><td>"), "\n", "</td></tr><tr><td>")
    return rows.select("item_id", t.html_table(F.concat(F.lit("<table><tr><td>"), cells, F.lit("</td></tr></table>"))).alias("markdown"))


def _listed_words(spark: SparkSession, d: str) -> DataFrame:
    """The words of the terms: one list for all books."""
    return read(spark, d, "terms").select(F.explode(F.regexp_extract_all("term", F.lit(lx.TOKEN), F.lit(0))).alias("word"))


def _quality(spark: SparkSession, d: str) -> DataFrame:
    lines = lines_of(spark, d)
    made = assemble.page_items(lines, regions_of(spark, d).withColumn("dropped", F.lit(None).cast("string")))
    return assemble.page_quality(lines, assemble.checked_texts(made), read(spark, d, "lexicon"), _listed_words(spark, d))


@query
def page_items(spark: SparkSession, d: str) -> DataFrame:
    """The texts of the pages that have lines, those of a page that go on joined."""
    made = assemble.page_items(lines_of(spark, d), regions_of(spark, d).withColumn("dropped", F.lit(None).cast("string")))
    return assemble.checked_texts(made)


@query
def quality_rank(spark: SparkSession, d: str) -> DataFrame:
    return assemble.proofreading_order(_quality(spark, d)).select(*PAGE, "lines", "low_conf_lines", "words", "unknown", "unknown_ratio", "rank")


@query
def unknown_topk(spark: SparkSession, d: str) -> DataFrame:
    return assemble.frequent_unknown(_quality(spark, d))


@query
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return assemble.quality_markdown(_quality(spark, d), read(spark, d, "books"))


@query
def listed_word_prefixes(spark: SparkSession, d: str) -> DataFrame:
    words = read(spark, d, "items").where("type = 'para'").select(F.explode(lx.checked_tokens(F.col("text"))).alias("word"))
    return lx.with_listed_words(words, _listed_words(spark, d))


@query
def book_word_prefixes(spark: SparkSession, d: str) -> DataFrame:
    """Words of a book's paragraphs that its headings have, or words with up to six letters behind one of theirs."""
    items = read(spark, d, "items")
    words = items.where("type = 'para'").select("book", F.explode(lx.checked_tokens(F.col("text"))).alias("word"))
    listed = items.where("type = 'heading'").select("book", F.explode(F.regexp_extract_all("text", F.lit(lx.TOKEN), F.lit(0))).alias("word"))
    return lx.with_book_words(words, listed)


@query
def vowels_mended(spark: SparkSession, d: str) -> DataFrame:
    """Hungarian paragraphs that lost their accents, with every word put right that has one repair."""
    hungarian = read(spark, d, "books").where("lang = 'hun'").select("book")
    texts = read(spark, d, "items").where("type = 'para'").join(hungarian, "book").select("item_id", F.translate("text", "áéíóöőúüű", "aeiooouuu").alias("text"))
    return lx.vowels_mended(texts, ["item_id"], read(spark, d, "lexicon").where("lang = 'hun'"))


@query
def vowel_fix(spark: SparkSession, d: str) -> DataFrame:
    lexicon = read(spark, d, "lexicon").where("lang = 'hun'")
    bare = lexicon.select(F.translate("word", "áéíóöőúüű", "aeiooouuu").alias("word"))
    return lx.vowel_repairs(bare, lexicon)


RULES = [(r"^([0-9]+) db ", "$1 darab "), (r" – ", " -- "), (r"\.\.\.$", "…")]


@query
def replacements(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "items").where("type = 'para'").select("item_id", t.replaced(F.col("text"), RULES).alias("text"))


@query
def page_select(spark: SparkSession, d: str) -> DataFrame:
    """Pages 2 to 40 and from 100 of every book, without 5, 7 and 9 to 11."""
    books = read(spark, d, "books").select("book", "n_pages")
    return config.selected_pages(books, ["2-40", "100-"], ["5", "7", "9-11"])


@query
def config_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Settings of each page, from a book's own and two overrides."""
    pages = read(spark, d, "page_layouts").select(*PAGE)
    rules = config.Settings({"columns": 2, "margins": {"inner": 0.06}}, [("3-", {"margins": {"top": 0.1}}), ("4,6", {"columns": 1})])
    of = lambda path, kind: F.get_json_object("settings", f"$.{path}").cast(kind)
    made = config.resolved(pages, rules)
    return made.select(*PAGE, of("columns", "int").alias("columns"), of("margins.top", "double").alias("top"), of("margins.inner", "double").alias("inner_margin"), of("margins.outer", "double").alias("outer_margin"), of("dpi", "int").alias("dpi"), of("layout_engine", "string").alias("layout_engine"))


@query
def stage_keys(spark: SparkSession, d: str) -> DataFrame:
    lines = lines_of(spark, d)
    texts = ln.region_text(lines)
    return texts.select("region_id", stream.stage_key(F.lit("ocr"), F.col("text")).alias("key"))


@query
def stale_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose lines changed since an earlier run, which had seen the pages with an even number."""
    now = stream.page_keys(lines_of(spark, d))
    return stream.stale(now, now.where("page % 2 = 0"))


@query
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    books, targets = read(spark, d, "books").select(F.col("publisher").alias("source")), read(spark, d, "mix_targets").select("source")
    both = books.intersect(targets).withColumn("side", F.lit("both"))
    return both.unionByName(books.subtract(targets).withColumn("side", F.lit("books"))).unionByName(targets.subtract(books).withColumn("side", F.lit("targets")))


@query
def box_statistics(spark: SparkSession, d: str) -> DataFrame:
    boxed = lines_of(spark, d).where("box is not null").withColumn("h", g.height(F.col("box")))
    made = boxed.groupBy("region_id").agg(F.median("h").alias("median_height"), F.sort_array(F.collect_list("h")).alias("hs"), F.sort_array(F.collect_list("box.x0")).alias("xs"), F.percentile("h", 0.9).alias("p90"), g.union_of(F.col("box")).alias("u"))
    upper = F.get("hs", F.floor(F.size("hs") / 2).cast("int"))
    return made.select("region_id", "median_height", upper.alias("upper_median"), F.get("xs", F.floor(F.size("xs") / 10).cast("int")).alias("left_edge"), F.round("p90", 4).alias("p90"), F.col("u.x1").alias("right"))


@query
def merge_words(spark: SparkSession, d: str) -> DataFrame:
    """Lines merged with a second reading of themselves that lost its accents."""
    lines = lines_of(spark, d).select("region_id", "line_no", "text", "box", "conf")
    other = lines.withColumn("text", F.translate("text", "áéíóöőúüű", "aeiooouuu"))
    return ln.ensemble_lines(other, lines, ["region_id"], _known(spark, d)).select("region_id", "line_no", "text")


@query
def recogniser_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines cut in two fragments, read again as rows."""
    lines = lines_of(spark, d).where("box is not null and line_no is not null and length(text) > 1")
    middle = (F.col("box.x0") + F.col("box.x1")) / 2
    half = F.floor(F.length("text") / 2).cast("int")
    part = lambda k, text, b: F.struct((F.col("line_no") * 2 + k).alias("ordinal"), text.alias("text"), b.alias("box"))
    left = part(0, F.substring(F.col("text"), F.lit(1), half), g.box(F.col("box.x0"), F.col("box.y0"), middle, F.col("box.y1")))
    right = part(1, F.substring(F.col("text"), half + 1, F.length("text")), g.box(middle, F.col("box.y0"), F.col("box.x1"), F.col("box.y1")))
    fragments = lines.select("region_id", "conf", F.explode(F.array(left, right)).alias("f")).select("region_id", "f.*", F.greatest("conf", F.lit(0.0)).alias("score"))
    return ln.recogniser_rows(fragments, ["region_id"]).select("region_id", "line_no", "text", "conf", F.round("box.x0", 3).alias("x0"), F.round("box.y1", 3).alias("y1"))


@query
def page_documents(spark: SparkSession, d: str) -> DataFrame:
    return pagejson.page_documents(read(spark, d, "page_layouts"), regions_of(spark, d), lines_of(spark, d))


@query
def recognised_pages(spark: SparkSession, d: str) -> DataFrame:
    """Regions read by the engine of their kind; the engines are stand-ins here."""
    return engines.recognise(regions_of(spark, d).where("dropped is null"), engines.Choice("lines", {"table": "markdown"}))


@query
def page_images(spark: SparkSession, d: str) -> DataFrame:
    """Drawn pages, turned as they were scanned, through the pixel steps: light, contrast, skew, frames, blocks."""
    layouts = read(spark, d, "page_layouts").select(*PAGE, "width", "height", "frames", "skew_deg")
    return pixels.drawn_and_analysed(layouts, regions_of(spark, d))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracles.SQL.items() if name in _QUERIES}


