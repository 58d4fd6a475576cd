"""Problem 3: statistics of each item and text region, and which of them are no running prose.

Counts are taken per Arrow batch with table look-ups over the code points of all its texts at once, summed per
item and region, and turned into shares on a grid of LEVELS steps. Per language and statistic the rows on each
step are counted over the whole corpus; the counts, at most languages x statistics x LEVELS rows at any input
size, are range-partitioned, sorted and numbered with partition offsets, which gives every row's exact rank and
so its empirical tail probabilities. Their logarithms, weighted, add up to the outlier score. The weights are
fitted on at most `max_labels` labelled rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .codes import CodeTable, Rolling, code_points, spans
from .glyphs import LOOKALIKES
from .streams import LANGS as LANGS_OF_BOOKS
from .streams import UNSPACED, Block, book_facts, facts_of, region_blocks, region_lines
from .tables import checkpointed

LEVELS = 1000
MAX_LABELS = 5000
#: Log odds above which a text is no prose; above 0 as the fit weighs both classes the same, but prose is far more common.
THRESHOLD = 0.95
MIN_LINES = 4
#: Words of each language that count as common ones.
COMMON_TOP = 50
#: Texts that are looked at together, so that their arrays stay in the processor's cache.
TOGETHER = 2500
#: Partitions of the range-partitioned counts.
RANGES = 4
COUNTS = ("lines", "chars", "words", "latin", "odd", "greek", "devanagari", "arabic", "cjk", "thai", "digits", "commas", "ends", "symbols", "capitals", "common", "numbers", "voiceless", "short", "closed", "listed", "raised", "repeats")
STATS = ("own_script", "letters", "digits", "symbols", "capitals", "common", "commas", "ends", "numbers", "voiceless", "word_length", "closed", "listed", "short", "odd", "raised", "repeats")

_LATIN = set("abcdefghijklmnopqrstuvwxyzáéíóöőúüűäßàâçèêëîïôùûœæÿñABCDEFGHIJKLMNOPQRSTUVWXYZÁÉÍÓÖŐÚÜŰÄÀÂÇÈÊËÎÏÔÙÛŒÆ")
_VOWELS = set("aeiouyáéíóöőúüűäàâèêëîïôùûœæAEIOUYÁÉÍÓÖŐÚÜŰÄÀÂÈÊËÎÏÔÙÛŒÆ")
_NAMES = ("latin", "odd", "greek", "devanagari", "arabic", "cjk", "thai", "digits", "commas", "ends", "symbols")
_QUOTES = "”“»\"')’」』"
_OPENING = "„“«–"


def _kind(char: str) -> int:
    """1 + position in _NAMES of a character's kind; 0 for white space and invisible characters."""
    code, category = ord(char), unicodedata.category(char)
    if category[0] in "LM":
        if char in _LATIN or "\u0300" <= char <= "\u036f" or 0xFB00 <= code <= 0xFB06 or char in LOOKALIKES and not 0x370 <= code <= 0x3FF:
            return 1  # Latin letters, ligatures, and letters of other scripts drawn as one; Greek ones may be Greek text
        for kind, low, high in ((3, 0x370, 0x3FF), (3, 0x1F00, 0x1FFF), (4, 0x900, 0x97F), (5, 0x600, 0x6FF), (5, 0x750, 0x77F), (6, 0x3040, 0x30FF), (6, 0x3400, 0x9FFF), (7, 0xE00, 0xE7F)):
            if low <= code <= high:
                return kind
        return 1 if 0xFF21 <= code <= 0xFF5A else 2
    if category[0] == "N":
        return 8
    if char in ",、，،;；":
        return 9
    if char in ".!?…。！？؟।":
        return 10
    return 0 if category in ("Zs", "Zl", "Zp", "Cc", "Cf") else 11


def _row(char: str) -> tuple:
    lower = char.lower()
    return _kind(char), unicodedata.category(char) == "Cf", char.isupper(), char in _VOWELS, ord(lower) if len(lower) == 1 else ord(char), char in _QUOTES, char in _OPENING


_CHARS = CodeTable({"kind": np.uint8, "hidden": bool, "upper": bool, "vowel": bool, "lower": np.uint32, "quote": bool, "opening": bool}, _row)


def word_keys(hashes: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """Hashes with the number of a language in the lowest four bits."""
    return hashes << np.uint64(4) | langs.astype(np.uint64)


def _is_in(known: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Which of the values are in a sorted array."""
    return known[np.minimum(np.searchsorted(known, sought), len(known) - 1)] == sought if len(known) else np.zeros(len(sought), bool)


def word_hashes(codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words, runs of letters and digits, begin and end, and their hashes in lower case."""
    first, last = spans((kind >= 1) & (kind <= 8))
    return first, last, Rolling(_CHARS["lower"][codes] + np.uint32(7)).of(first, last)


def text_counts(codes: np.ndarray, lengths: np.ndarray, common_words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """One row of COUNTS per text; `codes` are the texts' code points with a line break behind each. `common_words` are
    sorted keys of frequent words, `langs` the numbers of the texts' languages."""
    n = len(lengths)
    _CHARS.meet(codes)
    owner = np.repeat(np.arange(n, dtype=np.int32), lengths + 1)
    shown = ~_CHARS["hidden"][codes]  # invisible characters part no words
    if not shown.all():
        codes, owner = codes[shown], owner[shown]
    kind = _CHARS["kind"][codes]
    per_kind = np.bincount(owner * 12 + kind, minlength=12 * n).reshape(n, 12)
    of = lambda where: np.bincount(owner[where], minlength=n)
    first, last, hashes = word_hashes(codes, kind)
    common = _is_in(common_words, word_keys(hashes, langs[owner[first]]))
    size = last - first
    total = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
    digits, vowels, latin = total(kind == 8), total(_CHARS["vowel"][codes]), total((kind == 1) | (kind == 2))
    numeric = digits[last] > digits[first]
    all_latin = latin[last] - latin[first] == size
    voiceless = all_latin & (vowels[last] == vowels[first]) & (size >= 2) & ~common
    short = all_latin & (size <= 2) & ~common

    again = (hashes[1:] == hashes[:-1]) & (digits[last[1:]] == digits[first[1:]])

    # lines: the first and last visible character of each
    visible = np.flatnonzero(kind > 0)
    line = np.cumsum(codes == 10, dtype=np.int32)[visible]
    begins = np.concatenate([[True], line[1:] != line[:-1]]) if len(line) else np.zeros(0, bool)
    stops = np.concatenate([line[1:] != line[:-1], [True]]) if len(line) else np.zeros(0, bool)
    heads, tails = visible[begins], visible[stops]
    after = np.minimum(heads + 1, len(codes) - 1)
    listed = (kind[heads] == 11) & ~_CHARS["opening"][codes[heads]] | (kind[heads] == 8) | ((kind[heads] == 1) & (codes[after] == ord(")")))
    closed = (kind[tails] == 10) | _CHARS["quote"][codes[tails]]

    columns = {"lines": of(heads), "chars": per_kind[:, 1:].sum(1), "words": of(first), "capitals": of(first[_CHARS["upper"][codes[first]]]), "common": of(first[common]), "numbers": of(first[numeric]), "voiceless": of(first[voiceless]), "short": of(first[short]), "closed": of(heads[closed]), "listed": of(heads[listed]), "raised": of(heads[_CHARS["upper"][codes[heads]]]), "repeats": of(first[1:][again])}
    single = _SINGLE[langs]
    if single.any():  # where words are not parted, characters stand for them
        at = np.flatnonzero(((kind == 6) | (kind == 7)) & single[owner])
        known = at[_is_in(common_words, word_keys(codes[at].astype(np.uint64) + np.uint64(7), langs[owner[at]]))]
        columns["common"] = np.where(single, of(known), columns["common"])
    columns |= {name: per_kind[:, 1 + i] for i, name in enumerate(_NAMES)}
    # a text set with a space after every letter is a running head, whose words cannot be told
    spaced = (columns["words"] >= 8) & (per_kind[:, 1:9].sum(1) < 1.4 * columns["words"]) & (per_kind[:, 1:4].sum(1) > 0.6 * columns["chars"])
    made = np.stack([columns[c] for c in COUNTS], 1).astype(np.int32)
    made[spaced] = 0
    return made


# Counts of letters, and the one that is a language's own script; latin where none is named.
SCRIPTS = ("latin", "odd", "greek", "devanagari", "arabic", "cjk", "thai")
OWN_SCRIPT = {"ell": "greek", "hin": "devanagari", "ara": "arabic", "jpn": "cjk", "zho": "cjk", "tha": "thai"}
_NUMBER = {lang: i for i, lang in enumerate((*LANGS_OF_BOOKS, "und"))}
_SINGLE = np.array([lang in UNSPACED for lang in _NUMBER])
_SCRIPT = np.array([SCRIPTS.index(OWN_SCRIPT.get(lang, "latin")) for lang in _NUMBER])


def lang_numbers(langs: list[str]) -> np.ndarray:
    return np.array([_NUMBER[x] for x in langs], np.int64)


def _word_sums(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): how often each word stands in the texts (lang, text) of a task. No closure, so that the workers use their
    own tables of characters."""
    sums: dict[int, int] = {}
    for batch in source:
        for k in range(0, len(batch), TOGETHER):
            part = batch.slice(k, TOGETHER)
            _, codes, lengths = code_points(part.column("text").to_numpy(zero_copy_only=False).tolist())
            _CHARS.meet(codes)
            langs = lang_numbers(part.column("lang").to_pylist())
            owner = np.repeat(np.arange(len(part), dtype=np.int32), lengths + 1)
            shown = ~_CHARS["hidden"][codes]
            codes, owner = codes[shown], owner[shown]
            kind = _CHARS["kind"][codes]
            first, _, hashes = word_hashes(codes, kind)
            spaced = ~_SINGLE[langs[owner[first]]]
            at = np.flatnonzero(((kind == 6) | (kind == 7)) & _SINGLE[langs[owner]])
            found = np.concatenate([word_keys(hashes, langs[owner[first]])[spaced], word_keys(codes[at].astype(np.uint64) + np.uint64(7), langs[owner[at]])])
            for key, n in zip(*(x.tolist() for x in np.unique(found, return_counts=True))):
                sums[key] = sums.get(key, 0) + n
        if len(sums) > 500_000:
            yield _sums(sums)
            sums = {}
    yield _sums(sums)


def common_words(lines: DataFrame, items: DataFrame, books: DataFrame, top: int = COMMON_TOP) -> np.ndarray:
    """Keys of the `top` most frequent words, met twice or more, of each language over all lines and items, sorted; of languages that do not
    part words, of characters. The driver gets `top` keys per language of a fixed list."""
    texts = lines.select("book", "text").unionByName(items.select("book", "text")).where("text is not null")
    texts = texts.join(facts_of(books).select("book", "lang"), "book", "left").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")

    counts = texts.mapInArrow(_word_sums, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    rows = counts.where("n > 1").withColumn("lang", F.col("key").bitwiseAND(15)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("key").collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def _sums(sums: dict[int, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(list(sums), np.uint64).view(np.int64)), pa.array(np.array(list(sums.values()), np.int64))], names=["key", "n"])


def _int_lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, max(1, width), dtype=np.int32)[: n + 1] if width else np.zeros(n + 1, np.int32)), pa.array(np.ascontiguousarray(rows, np.int32).ravel()))


def region_counts(block: Block, codes: np.ndarray, lengths: np.ndarray, common_words: np.ndarray, min_lines: int = MIN_LINES) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a block's text regions of `min_lines` lines or more, and their COUNTS without the lines left out."""
    made = text_counts(codes, lengths, common_words, lang_numbers(block.facts["lang"])[block.region])
    made[block.out] = 0
    n_lines = np.diff(np.concatenate([block.starts, [len(block.texts)]]))
    wanted = np.flatnonzero((n_lines >= min_lines) & np.array([k == "text" for k in block.facts["kind"]], bool))
    return wanted, np.add.reduceat(made, block.starts, axis=0)[wanted]


def statistics(counts: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """STATS of rows of COUNTS in languages, as whole numbers from 0 to LEVELS; shares of nothing are 0."""
    of = {c: counts[:, i].astype(np.int64) for i, c in enumerate(COUNTS)}
    letters = sum(of[c] for c in SCRIPTS)
    own = np.select([_SCRIPT[langs] == k for k in range(len(SCRIPTS))], [of[c] for c in SCRIPTS])

    def share(a: np.ndarray, b: np.ndarray, most: int = 1, step: int = 1) -> np.ndarray:
        grid = np.minimum(LEVELS, a * LEVELS // np.maximum(b * most, 1))
        return np.where(b > 0, grid, 0) // step * step

    words, lines = of["words"], of["lines"]
    made = {
        # in steps of a twentieth: single foreign letters say nothing
        "own_script": np.minimum(LEVELS, -(-(share(own, letters) + 40) // 50) * 50), "letters": share(letters, of["chars"]), "word_length": share(letters, words, 40), "odd": share(of["odd"], letters, 1, 50),
        "common": share(of["common"], np.where(_SINGLE[langs], of["chars"], words)), **{c: share(of[c], of["chars"]) for c in ("digits", "symbols")},
        **{c: share(of[c], words) for c in ("capitals", "commas", "ends", "numbers", "voiceless", "short", "repeats")}, **{c: share(of[c], lines) for c in ("closed", "listed", "raised")},
    }
    return np.stack([made[s] for s in STATS], 1) if len(counts) else np.zeros((0, len(STATS)), np.int64)


def _counts_in(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("counts").flatten().to_numpy().reshape(-1, len(COUNTS)), lang_numbers(batch.column("lang").to_pylist())


COUNTED = "tbl string, id long, lang string, counts array<int>"


def prose_items(items: DataFrame, books: DataFrame) -> DataFrame:
    """(id, book, page, text, lang, offset): paragraphs that are not standalone; a null text counts as empty."""
    kept = items.where("type = 'para' and not coalesce(standalone, false) and item_id is not null").select(F.col("item_id").alias("id"), "book", "page", F.coalesce("text", F.lit("")).alias("text"))
    return kept.join(facts_of(books), "book", "left").withColumn("lang", F.coalesce("lang", F.lit("und")))


def counted_texts(lines: DataFrame, regions: DataFrame, items: DataFrame, books: DataFrame, common_words: np.ndarray, furniture: DataFrame | None = None, min_lines: int = MIN_LINES) -> DataFrame:
    """COUNTED rows of each para item that is not standalone and of each text region with `min_lines` lines or more.
    Lines in `furniture` (line_id, region_id) are among the lines, but their text does not count.

    Lines and regions delivered twice count once. A null text counts as empty, a null or unknown language as 'und'. Empty
    texts have all statistics 0."""

    def of_regions(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in region_blocks(source):
            _, codes, lengths = code_points(block.texts)
            wanted, made = region_counts(block, codes, lengths, common_words, min_lines)
            facts = [pa.array([block.facts[c][k] for k in wanted], t) for c, t in (("region_id", pa.int64()), ("lang", pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array(["region"] * len(wanted), pa.string()), *facts, _int_lists(made)], names=["tbl", "id", "lang", "counts"])

    def of_items(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            _, codes, lengths = code_points(batch.column("text").to_pylist())
            made = text_counts(codes, lengths, common_words, lang_numbers(batch.column("lang").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(["item"] * len(batch), pa.string()), batch.column("id"), batch.column("lang"), _int_lists(made)], names=["tbl", "id", "lang", "counts"])

    per_region = region_lines(lines, regions, books, furniture, "text").mapInArrow(of_regions, COUNTED)
    return per_region.unionByName(prose_items(items, books).select("id", "text", "lang").mapInArrow(of_items, COUNTED))


def level_counts(counted: DataFrame) -> DataFrame:
    """(lang, stat, level, n) of COUNTED rows, from every task one row per level at most."""
    width = LEVELS + 1

    def counted_levels(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(_NUMBER), len(STATS), width), np.int64)
        for batch in source:
            counts, langs = _counts_in(batch)
            place = (langs[:, None] * len(STATS) + np.arange(len(STATS))) * width + statistics(counts, langs)
            sums += np.bincount(place.ravel(), minlength=sums.size).reshape(sums.shape)
        lang, stat, level = np.nonzero(sums)
        names = np.array(list(_NUMBER), object)
        yield pa.RecordBatch.from_arrays([pa.array(names[lang].tolist(), pa.string()), pa.array(stat.astype(np.int32)), pa.array(level.astype(np.int32)), pa.array(sums[lang, stat, level])], names=["lang", "stat", "level", "n"])

    made = counted.select("lang", "counts").mapInArrow(counted_levels, "lang string, stat int, level int, n long")
    return made.groupBy("lang", "stat", "level").agg(F.sum("n").alias("n"))


def exact_tails(counts: DataFrame) -> DataFrame:
    """(lang, stat, level, below, above) of counts (lang, stat, level, n): the share of rows of the language at or
    below the level and at or above it, from exact ranks; rows on one level tie."""
    parts = counts.repartitionByRange(RANGES, "lang", "stat", "level").sortWithinPartitions("lang", "stat", "level")
    parts = checkpointed(parts.withColumn("part", F.spark_partition_id()))  # both branches must see the same partitions
    offsets = parts.groupBy("lang", "stat", "part").agg(F.sum("n").alias("in_part"))
    by_part = Window.partitionBy("lang", "stat").orderBy("part")
    offsets = offsets.select("lang", "stat", "part", (F.sum("in_part").over(by_part) - F.col("in_part")).alias("offset"), F.sum("in_part").over(Window.partitionBy("lang", "stat")).alias("total"))
    local = Window.partitionBy("part", "lang", "stat").orderBy("level")
    ranked = parts.withColumn("upto", F.sum("n").over(local)).join(offsets, ["lang", "stat", "part"])
    return ranked.select("lang", "stat", "level", ((F.col("offset") + F.col("upto")) / F.col("total")).alias("below"), ((F.col("total") - F.col("offset") - F.col("upto") + F.col("n")) / F.col("total")).alias("above"))


def tail_table(tails: list, langs: list[str]) -> np.ndarray:
    """[language][statistic][level][lower, upper]: minus the logarithm of the tail probabilities; levels that do
    not occur take the values of the level below and above. Languages x statistics x LEVELS numbers, no more."""
    share = np.zeros((len(langs), len(STATS), LEVELS + 1, 2))
    place = {lang: i for i, lang in enumerate(langs)}
    for lang, stat, level, below, above in tails:
        share[place[lang], stat, level] = below, above
    share[..., 0] = np.maximum.accumulate(share[..., 0], axis=2)
    share[..., 1] = np.maximum.accumulate(share[:, :, ::-1, 1], axis=2)[:, :, ::-1]
    return -np.log(np.maximum(share, 1e-12))


def tail_features(stats: np.ndarray, lang: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row its lower and upper tails, one after the other, of all statistics."""
    picked = table[lang[:, None], np.arange(len(STATS))[None, :], stats]
    return picked.reshape(len(stats), 2 * len(STATS))


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights >= 0 of tail features and the bias of a logistic model (labels 0 and 1), by projected Newton-scaled
    gradient steps; the two classes weigh the same."""
    if not len(y) or y.min() == y.max():
        return np.full(x.shape[1] if x.ndim == 2 else 2 * len(STATS), 1 / len(STATS)), -3.0
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, b = np.zeros(x.shape[1]), 0.0
    rate = 1 / (0.25 * (share[:, None] * x**2).mean(0).sum() + penalty)
    for _ in range(steps * 20):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = share * (p - y)
        w = np.maximum(0, w - rate * 4 * (x.T @ g / len(y) + penalty * w))
        b -= 0.5 * g.mean()
    return w, b


def outliers(counted: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """(tbl, id, lang, chars, stats, score) of checkpointed COUNTED rows: the statistics and an outlier score, above
    THRESHOLD for what is no prose."""
    tails = exact_tails(level_counts(counted)).collect()  # at most languages x len(STATS) x (LEVELS + 1) rows, and the languages are a fixed list
    table = tail_table(tails, list(_NUMBER))
    marked = labels.where("tbl is not null and id is not null and form is not null").groupBy("tbl", "id").agg(F.min(F.when(F.col("form") == "prose", 0).otherwise(1)).alias("y")).orderBy(F.xxhash64("tbl", "id")).limit(max_labels)
    seen = counted.join(F.broadcast(marked), ["tbl", "id"]).select("counts", "lang", "y").collect()
    langs = lang_numbers([r.lang for r in seen])
    x = tail_features(statistics(np.array([r.counts for r in seen], np.int64).reshape(-1, len(COUNTS)), langs), langs, table)
    w, b = fit_weights(x, np.array([r.y for r in seen], float))

    def scored(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            counts, langs = _counts_in(batch)
            stats = statistics(counts, langs)
            score = tail_features(stats, langs, table) @ w + b if len(langs) else np.zeros(0)
            chars = pa.array(np.ascontiguousarray(counts[:, COUNTS.index("chars")], np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("tbl", "id", "lang")), chars, _int_lists(stats), pa.array(score)], names=["tbl", "id", "lang", "chars", "stats", "score"])

    return counted.select("tbl", "id", "lang", "counts").mapInArrow(scored, "tbl string, id long, lang string, chars int, stats array<int>, score double")


def bad_texts(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """(tbl, id) of the COUNTED rows whose text is no running prose; without any text they are no case."""
    return outliers(counted, labels).where((F.col("score") > THRESHOLD) & (F.col("chars") > 0)).select("tbl", "id")


def not_prose(lines: DataFrame, regions: DataFrame, items: DataFrame, books: DataFrame, labels: DataFrame, furniture: DataFrame | None = None) -> DataFrame:
    """(tbl, id) of the items and regions whose text is no running prose; without any text they are no case."""
    books = book_facts(books)
    return bad_texts(checkpointed(counted_texts(lines, regions, items, books, common_words(lines, items, books), furniture)), labels)
