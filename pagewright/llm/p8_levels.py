"""Problem 8: the reading level of each document, by smoothed unigram language models.

For every language and level a unigram model is counted on the labelled documents (words, and one token per
sentence for its length) and smoothed towards the shares of word lengths at that level over all languages, so
that words never seen there still speak for a level. As the sample is small, the models are then counted again on the
prose of all documents, every paragraph weighed by its posterior (the labelled ones count LABEL_WEIGHT times), over
the words of the sample and the lexicon. Each paragraph of running prose gets a posterior over the
levels; a document's level is the one that most of its prose, by letters, is written in. Counting and
scoring are map steps with one small aggregation; the model is bounded by the sample's and the lexicon's words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGS = ("hun", "eng", "deu", "fra")
LEVELS = (1, 2, 3, 4)
#: Most labelled documents that the models are counted on.
MAX_LABELS = 5000
#: Most lexicon words that are sent to the executors; a longer list is refused.
MAX_LEXICON = 2_000_000
#: Tokens that the shares of word lengths count for in each model.
SMOOTHING = 100.0
LABEL_WEIGHT = 3.0
#: Rounds over all documents.
ROUNDS = 1
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?…]+")
_JOINED = re.compile(r"[-‐¬­]\n(?=\w)")
_PARAGRAPH = re.compile(r"\n\s*\n")
_NO_PROSE = re.compile(r"\s*(?:#|[•▪■◆●○‣*▫◦]|[-–—]\s+\S+(?:\s\S+){0,4}$|\d+[.)]\s|[a-z]\)\s|\||©|\[)")
LONGEST, LONGEST_SENTENCE = 16, 12


def prose_paragraphs(text: str, every_line: bool = False) -> Iterator[list[str]]:
    """The words and sentence tokens of each paragraph of running prose: headings, list entries and tables
    aside, unless `every_line` is set. A sentence token is '<n>' with the number of words in steps of four."""
    for paragraph in _PARAGRAPH.split(_JOINED.sub("", text)):
        lines = [line for line in paragraph.split("\n") if every_line or not _NO_PROSE.match(line)]
        tokens: list[str] = []
        for sentence in _SENTENCE.split("\n".join(lines)):
            words = _WORD.findall(sentence)
            if words:
                tokens += words
                if len(words) > 2:
                    tokens.append(f"<{min(len(words) // 4, LONGEST_SENTENCE)}>")
        if tokens:
            yield [t.lower() for t in tokens]


def _length_class(token: str) -> int:
    """0 … LONGEST for words by their letters, above that the sentence tokens."""
    return LONGEST + 1 + int(token[1:-1]) if token[0] == "<" else min(len(token), LONGEST)


class LevelModels:
    """Log likelihoods of tokens per level, a table of rows for each language."""

    def __init__(self, counts: list[tuple[str, int, str, float]], words: dict[str, set[str]] | None = None, smoothing: float = SMOOTHING):
        n_classes = LONGEST + LONGEST_SENTENCE + 2
        shares = np.full((n_classes, len(LEVELS)), 0.5)
        for _, level, token, n in counts:
            shares[_length_class(token), level - 1] += n
        shares /= shares.sum(0)
        self.rows: dict[str, dict[str, int]] = {}
        self.tables: dict[str, np.ndarray] = {}
        for lang in LANGS:
            seen = {w: np.zeros(len(LEVELS)) for w in sorted((words or {}).get(lang, ()))}
            for of, level, token, n in counts:
                if of == lang and level in LEVELS:
                    seen.setdefault(token, np.zeros(len(LEVELS)))[level - 1] += n
            in_class = np.full(n_classes, 1.0)  # words of a class share its weight; one more for the unseen
            for token in seen:
                in_class[_length_class(token)] += 1
            totals = sum(seen.values(), np.zeros(len(LEVELS)))
            # row k < n_classes: an unseen token of class k
            backoff = shares / in_class[:, None]
            table = [np.log(smoothing * backoff / (totals + smoothing))]
            self.rows[lang] = {}
            for token, n in seen.items():
                self.rows[lang][token] = n_classes + len(self.rows[lang])
            made = [(n + smoothing * backoff[_length_class(token)]) / (totals + smoothing) for token, n in seen.items()]
            self.tables[lang] = np.concatenate([*table, np.log(np.array(made).reshape(-1, len(LEVELS)))])

    def paragraphs(self, text: str, lang: str, every_line: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The table rows of each paragraph's tokens, and its posterior over the levels."""
        rows, table = self.rows[lang], self.tables[lang]
        for tokens in prose_paragraphs(text, every_line):
            at = np.array([rows.get(t) or _length_class(t) for t in tokens])
            score = table[at].sum(0)
            likely = np.exp(score - score.max())
            yield at, likely / likely.sum()

    def shares(self, text: str, lang: str) -> np.ndarray:
        """Tokens of the text's prose by level; of all of its lines where it has no prose."""
        total = np.zeros(len(LEVELS))
        for every_line in (False, True):
            for at, likely in self.paragraphs(text, lang, every_line):
                total += likely * len(at)
            if total.any():
                break
        return total


def label_counts(documents: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> list[tuple[str, int, str, float]]:
    """(lang, level, token, weight) over at most `max_labels` labelled documents; a document with several
    raters counts for each of their levels in equal parts."""
    rated = labels.where(F.col("level").isin(*LEVELS) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.collect_list("level").alias("levels")).orderBy(F.xxhash64("doc_id")).limit(max_labels)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = []
            for text, lang, levels in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "levels"))):
                for tokens in prose_paragraphs(text or ""):
                    out += [(lang, level, t, 1 / len(levels)) for t in tokens for level in levels]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.float64()))], names=["lang", "level", "token", "n"])

    sample = documents.where(F.col("lang").isin(*LANGS)).select("doc_id", "text", "lang").join(F.broadcast(rated), "doc_id")
    counts = sample.select("text", "lang", "levels").mapInArrow(batches, "lang string, level int, token string, n double").groupBy("lang", "level", "token").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in counts.collect()]


def expected_counts(documents: DataFrame, models: LevelModels) -> list[tuple[str, int, str, float]]:
    """(lang, level, token, weight) over the prose of all documents, by the models' posteriors; only tokens that
    the models know, so no more rows than they have."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lang: np.zeros_like(table) for lang, table in models.tables.items()}
        for batch in source:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                for at, likely in models.paragraphs(text or "", lang):
                    np.add.at(sums[lang], at, likely)
        for lang, rows in models.rows.items():
            place = np.fromiter(rows.values(), np.int64, len(rows))
            words = pa.array(list(rows), pa.string())
            for level in LEVELS:
                n = sums[lang][place, level - 1] if len(rows) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(np.full(len(rows), level, np.int32)), words, pa.array(n)], names=["lang", "level", "token", "n"])

    kept = documents.where(F.col("lang").isin(*LANGS)).select("lang", "text")
    counts = kept.mapInArrow(batches, "lang string, level int, token string, n double").where("n > 0").groupBy("lang", "level", "token").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in counts.collect()]


def level_models(documents: DataFrame, labels: DataFrame, lexicon: DataFrame, max_labels: int = MAX_LABELS) -> LevelModels:
    """The models of the labelled sample, counted again on all documents in ROUNDS rounds."""
    words: dict[str, set[str]] = {}
    rows = lexicon.where(F.col("lang").isin(*LANGS) & F.col("word").isNotNull()).select("lang", "word").limit(MAX_LEXICON + 1).collect()
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} words")
    for row in rows:
        words.setdefault(row.lang, set()).add(row.word)
    sample = label_counts(documents, labels, max_labels)
    models = LevelModels(sample, words)
    for _ in range(ROUNDS if sample else 0):
        models = LevelModels(expected_counts(documents, models) + [(lang, level, token, LABEL_WEIGHT * n) for lang, level, token, n in sample], words)
    return models


def reading_levels(documents: DataFrame, labels: DataFrame, lexicon: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """(doc_id, lang, level, share): the level that most of a document's prose is written in, and its share.

    Documents in other or unknown languages and null doc_ids have no row; a null text, an empty one or one without
    any word has a null level and share 0, one without prose the level of its other lines. Labels outside the scale are left out."""
    models = level_models(documents, labels, lexicon, max_labels)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            levels, shares = [], []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                tokens = models.shares(text or "", lang)
                best = int(tokens.argmax())
                levels.append(best + 1 if tokens.sum() else None)
                shares.append(float(tokens[best] / tokens.sum()) if tokens.sum() else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(levels, pa.int32()), pa.array(shares)], names=["doc_id", "lang", "level", "share"])

    kept = documents.where(F.col("lang").isin(*LANGS) & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    return kept.mapInArrow(batches, "doc_id long, lang string, level int, share double")


def level_profile(levels: DataFrame) -> DataFrame:
    """(lang, level, documents, mean_share): how the corpus spreads over the levels."""
    return levels.groupBy("lang", "level").agg(F.count("*").alias("documents"), F.round(F.avg("share"), 4).alias("mean_share"))
