"""Recognised words and lines: filters, grouping of words into lines, pairing of two readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reconcile import merged_text
from . import geometry as g
from .ordering import group_rows

# Short Hungarian words that are no scraps, and such that stay at a line's end.
SHORT = "a az s és is ez e ha le be ki ne se el ő ők én te mi ti ma no jó fő kő ló tó új év út id pl km kp tp ép -- – — -".split()
KEPT_AT_ENDS = "a s e é ó ő A S É Ó Ő — – -".split()
LOW_CONFIDENCE = 0.85


def latest_lines(lines: DataFrame) -> DataFrame:
    """Lines delivered more than once under one line_id, once: as read last; nulls count as read first."""
    last = Window.partitionBy("line_id").orderBy(F.col("read_at").desc_nulls_last(), "text")
    return lines.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def is_low_confidence(conf: Column) -> Column:
    """Known (not negative) and under LOW_CONFIDENCE; null is not low."""
    return F.coalesce((conf >= 0) & (conf < LOW_CONFIDENCE), F.lit(False))


def kept_words(words: DataFrame, min_conf: float = 30) -> DataFrame:
    """Words that are not blank, have a confidence, and reach `min_conf` unless they hold a digit."""
    return words.where((F.trim("word") != "") & (F.col("conf") >= 0) & ((F.col("conf") >= min_conf) | F.col("word").rlike(r"\p{Nd}")))


def edge_trimmed(words: DataFrame, keys: list[str], max_conf: float = 70) -> DataFrame:
    """`words` (keys, word_no, word, conf) without the scraps of one or two characters at both ends of a line."""
    scrap = (F.length("word") <= 2) & (F.col("conf") < max_conf) & ~F.col("word").isin(*KEPT_AT_ENDS) & ~F.col("word").rlike(r"^\p{Nd}+$")
    line = Window.partitionBy(*keys)
    real = F.when(~scrap, F.col("word_no"))
    return words.withColumn("_a", F.min(real).over(line)).withColumn("_z", F.max(real).over(line)).where("word_no between _a and _z").drop("_a", "_z")


def is_junk(words: Column) -> Column:
    """Whether an array of three words or more is mostly scraps of one or two letters."""
    scrap = lambda w: (F.length(F.btrim(w, F.lit(".,;:!?\"'()[]"))) <= 2) & ~F.lower(F.btrim(w, F.lit(".,;:!?\"'()[]"))).isin(*SHORT)
    return F.coalesce((F.size(words) >= 3) & (F.size(F.filter(words, scrap)) >= 0.6 * F.size(words)), F.lit(False))


def word_lines(words: DataFrame, keys: list[str], min_conf: float = 30, edge_conf: float = 70, pad: float = 20) -> DataFrame:
    """`keys`, line_no, par, text, box, conf from recognised words (keys, word_no, block, par, line, word, conf, box).

    Lines and paragraphs are numbered as their first kept word comes; confidence is the mean over the words
    before scraps are cut at the ends, in hundredths; lines of scraps only have no row."""
    kept = kept_words(words, min_conf)
    at = [*keys, "block", "par", "line"]
    of_line = kept.groupBy(*at).agg(F.min("word_no").alias("_first"), F.round(F.avg("conf") / 100, 3).alias("conf"), g.union_of(F.col("box")).alias("_box"))
    text = edge_trimmed(kept.select(*at, "word_no", "word", "conf"), at, edge_conf).groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("word_no", "word"))).alias("_words"))
    paragraphs = kept.groupBy(*keys, "block", "par").agg(F.min("word_no").alias("_par_first"))
    numbered = paragraphs.withColumn("_par", F.row_number().over(Window.partitionBy(*keys).orderBy("_par_first")) - 1)
    made = of_line.join(text, at).join(numbered, [*keys, "block", "par"]).withColumn("_w", F.col("_words.word")).where(~is_junk(F.col("_w")))
    order = Window.partitionBy(*keys).orderBy("_first")
    shift = lambda c: (F.col(f"_box.{c}") - pad).alias(c)
    return made.select(*keys, (F.row_number().over(order) - 1).alias("line_no"), F.col("_par").alias("par"), F.array_join("_w", " ").alias("text"), F.struct(*(shift(c) for c in ("x0", "y0", "x1", "y1"))).alias("box"), "conf")


def paired_lines(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """`primary` (keys, line_no, text, box, conf) with `partners`: the texts of the second reading's lines on the
    same row, from left to right; empty where there is none or no box."""
    others = secondary.where("box is not null").select(*keys, F.col("text").alias("_text"), F.col("box").alias("_box"))
    pairs = primary.where("box is not null").select(*keys, "line_no", "box").join(others, keys).where(g.same_row(F.col("box"), F.col("_box")))
    found = pairs.groupBy(*keys, "line_no").agg(F.sort_array(F.collect_list(F.struct(F.col("_box.x0").alias("x0"), F.col("_text").alias("text")))).alias("_p"))
    return primary.join(found.select(*keys, "line_no", F.col("_p.text").alias("partners")), [*keys, "line_no"], "left").withColumn("partners", F.coalesce("partners", F.array().cast("array<string>")))


def ensemble_lines(primary: DataFrame, secondary: DataFrame, keys: list[str], known: frozenset[str]) -> DataFrame:
    """`primary` with its text mended by the second reading's lines on the same row: what two engines together read.
    `known` is a checked, bounded list; a line without a partner stays as it is."""
    paired = paired_lines(primary, secondary, keys)
    return paired.withColumn("text", merged_text(F.col("text"), F.col("partners"), is_low_confidence(F.col("conf")), known)).drop("partners")


def recogniser_rows(fragments: DataFrame, keys: list[str], min_score: float = 0.5, least: float = 4.0) -> DataFrame:
    """`keys`, line_no, text, box, conf from a recogniser's fragments (keys, ordinal, text, score, box): without those of
    less than `least` in width or height, empty ones and those under `min_score`, rows from the top, each from left to
    right, with the score of its worst part."""
    big = (g.width(F.col("box")) >= least) & (g.height(F.col("box")) >= least)
    read = (F.coalesce(F.trim("text"), F.lit("")) != "") & (F.col("score") >= min_score)
    kept = fragments.where(big & read).select(*keys, "ordinal", "text", "score", "box")
    placed = group_rows(kept, keys).join(kept, [*keys, "ordinal"])
    words = F.sort_array(F.collect_list(F.struct("place", "ordinal", "text")))
    return placed.groupBy(*keys, F.col("row_no").alias("line_no")).agg(F.array_join(words["text"], " ").alias("text"), g.union_of(F.col("box")).alias("box"), F.round(F.min("score"), 3).alias("conf"))


def answer_lines(answers: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, line_no, par, text: the lines of a model's answer (keys, answer); a paragraph begins after a blank
    line that follows text."""
    lines = answers.select(*keys, F.posexplode(F.split("answer", "\n")).alias("_at", "_raw")).withColumn("text", F.trim("_raw"))
    order = Window.partitionBy(*keys).orderBy("_at")
    before = F.lag("text").over(order)
    lines = lines.withColumn("_new", ((F.col("text") == "") & (F.coalesce(before, F.lit("")) != "")).cast("int"))
    lines = lines.withColumn("par", F.sum("_new").over(order).cast("int")).where("text <> ''")
    return lines.select(*keys, (F.row_number().over(order) - 1).alias("line_no"), "par", "text")


def region_text(lines: DataFrame) -> DataFrame:
    """(region_id, text): the lines of each region in order, one below the other."""
    ordered = F.sort_array(F.collect_list(F.struct("line_no", "line_id", "text")))
    return lines.where("text is not null").groupBy("region_id").agg(F.array_join(ordered["text"], "\n").alias("text"))
