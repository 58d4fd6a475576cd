"""Problem 1: lines that stand on page after page of one book.

Every line is folded (width, case, accents, look-alike and commonly misread shapes), cut into content-defined
chunks by a rolling hash, and known by three chunk fingerprints of its book: from its start to the first cut
after MIN_CHUNK characters, from its last such cut to its end, and between. Rows and pages are counted per book and
line; of each chunk the commonest line that comes back is its centre, and a line with the same chunk belongs to it if an
edit distance over the folded letters finds at most two misread spots. The pages of a centre's lines are then counted
exactly, and lines on `min_pages` different pages are cut.

Pages of a single chunk alone do not tell the cases: copies that are each misread in another chunk share no chunk on
enough pages, and heads that differ in a word share one on too many. Only fingerprints are shuffled, each side is
pre-aggregated, and no step pairs lines: a line meets at most the commonest lines of its three chunks, so a book or
line that holds a third of all rows costs no more than others. Texts are looked up again only for one line of each folded
form that differs from its centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import STEP, CodeTable, Rolling, code_points, mixed, powers, spans, text_hash
from .glyphs import DIGITS, FOLD, PAIR_FOLDS, ROMAN, SHAPE_FOLDS, number_value
from .tables import checkpointed

MIN_PAGES = 6
MIN_LETTERS = 8
MIN_CHUNK = 6
MIN_KEY = 4
CUT_ONE_IN = 3
WINDOW = 4
LENGTH_STEP, LENGTH_SLACK = 8, 3
MAX_LETTER_CHANGES = 5
#: Edits of folded letters that two misread spots come to: a spot is a letter for a letter or for a pair.
MAX_EDITS = 3
#: Lines that are looked up by sending their ids to the executors, 40 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

FINGERPRINTS = "item boolean, page int, key long, c1 long, c2 long, c3 long, bag long, n int"
WHOLE = "item boolean, line_id long, region_id long, book string, page int, moved int, key long"
LETTERS = "wanted long, cluster long, key long, letters string"


def _fold_row(char: str) -> tuple[bool, int, int]:
    folded = FOLD[ord(char)]
    if folded and not folded.strip():
        folded = " "
    begin = len(_FLAT)
    _FLAT.extend(map(ord, folded))
    return char.isalpha(), len(folded), begin


_FLAT: list[int] = []
_FOLDS = CodeTable({"letter": bool, "size": np.uint8, "begin": np.int32}, _fold_row)
_SHAPES = np.arange(128, dtype=np.uint32)
_SHAPES[[ord(c) for c in SHAPE_FOLDS]] = [ord(c) for c in SHAPE_FOLDS.values()]
_NUMERIC = np.zeros(128, bool)
_NUMERIC[[ord(c) for c in [*ROMAN, *"0123456789"]]] = True
_DIGITS = np.arange(128, dtype=np.uint32)
_DIGITS[list(DIGITS)] = [ord(c) for c in DIGITS.values()]
_VALUES: dict[str, int | None] = {}
#: Lines that are looked at together, so that their arrays stay in the processor's cache.
TOGETHER = 2500


def folded_codes(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded characters and their owners; one character gives none, one or several."""
    _FOLDS.meet(codes)
    flat, size, begin = np.array(_FLAT, np.uint32), _FOLDS["size"][codes].astype(np.int64), _FOLDS["begin"][codes]
    if size.max(initial=0) <= 1:
        kept = size > 0
        return flat[begin[kept]], owner[kept]
    ends = np.cumsum(size)
    within = np.arange(ends[-1]) - np.repeat(ends - size, size)
    return flat[np.repeat(begin, size) + within], np.repeat(owner, size)


def pair_folded(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter pairs that scanners take for one letter as that letter, and single letters by their shapes."""
    for pair, one in PAIR_FOLDS:
        a, b = map(ord, pair)
        at = np.flatnonzero(codes[:-1] == a)
        at = at[codes[at + 1] == b]
        at = at[owner[at] == owner[at + 1]]
        if len(at) and a == b:  # of a row of equal letters every other one begins a pair
            fresh = np.concatenate([[True], np.diff(at) > 1])
            group = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - group) % 2 == 0]
        if len(at):
            codes = codes.copy()
            codes[at] = ord(one)
            kept = np.ones(len(codes), bool)
            kept[at + 1] = False
            codes, owner = codes[kept], owner[kept]
    return np.where(codes < 128, _SHAPES[np.minimum(codes, 127)], codes), owner


def _end_number(word: str) -> int | None:
    """Page number that a first or last word states, a misread digit included, else None."""
    if word in _VALUES:
        return _VALUES[word]
    value = number_value(word)
    if value is None and len(word) < 5 and any(c in "0123456789" for c in word):
        digit_like = word.replace("o", "0").replace("l", "1").replace("i", "1").replace("s", "5")
        value = int(digit_like) if digit_like.isdigit() else None
    if len(_VALUES) < 500_000:
        _VALUES[word] = value
    return value


def _stated_values(f: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number that each word states, and whether it states any; each different word is looked at once."""
    _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    numbers = [_end_number(f[b:e].tobytes().decode("utf-32-le")) for b, e in zip(begin[at].tolist(), end[at].tolist())]
    value = np.array([n or 0 for n in numbers], np.int64)
    return value[which], np.array([n is not None for n in numbers], bool)[which]


def _stretches(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the stretches, one stretch after the other, and the number of the stretch at each."""
    size = end - begin
    upto = np.cumsum(size)
    which = np.repeat(np.arange(len(begin), dtype=np.int32), size)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin - (upto - size), size), which


def line_keys(texts: list[str], pages: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the lines with MIN_LETTERS letters or more: text number, number minus page and whether there is one, salt, and
    the key's letters as code points with their number per key. A line with a number at an end has a further key
    without it. Spaces are left out, digits beside letters are letters, and other numbers enter the salt."""
    n = len(texts)
    _, codes, lengths = code_points(texts)
    owner = np.repeat(np.arange(n, dtype=np.int32), lengths + 1)
    f, of = folded_codes(codes, owner)
    enough = np.bincount(owner[_FOLDS["letter"][codes]], minlength=n) >= MIN_LETTERS
    ink = f != 32
    begin, end = spans(ink)
    line = of[begin]
    shown = enough[line]
    begin, end, line = begin[shown], end[shown], line[shown]
    none = np.zeros(0, np.int64)
    if not len(line):
        return none, none, none.astype(bool), none.astype(np.uint64), none.astype(np.uint32), none
    digit = (f >= 48) & (f < 58)
    small = np.minimum(f, 127)
    digits, numeric = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (digit, _NUMERIC[small] & (f < 128)))
    n_digits = digits[end] - digits[begin]
    mixed_word, number = (n_digits > 0) & (n_digits < end - begin), n_digits == end - begin
    if mixed_word.any():
        at, _ = _stretches(begin[mixed_word], end[mixed_word])
        f = f.copy()
        f[at] = np.where(f[at] < 128, _DIGITS[np.minimum(f[at], 127)], f[at])
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    last = np.concatenate([first[1:], [len(line)]]) - 1
    # keys are stretches of words: the line, and the line without its first or last word where that is a number
    rows, low, high = line[first], first, last + 1
    moved, stated = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
    likely = (numeric[end] - numeric[begin] == end - begin) | (n_digits > 0) & (end - begin < 5)
    several = last > first
    raw = Rolling(f)
    parts = [(rows, low, high, moved, stated)]
    for at, a, b in ((first, first + 1, last + 1), (last, first, last)):
        k = np.flatnonzero(several & likely[at])
        if len(k):
            w = at[k]
            value, known = _stated_values(f, begin[w], end[w], raw.of(begin[w], end[w]))
            k, value = k[known], value[known]
            parts.append((rows[k], a[k], b[k], value - pages[rows[k]], np.ones(len(k), bool)))
    rows, low, high, moved, stated = (np.concatenate(x) for x in zip(*parts))
    numbers = Rolling(mixed(raw.of(begin[number], end[number])))
    before = np.concatenate([[0], np.cumsum(number)])
    salt = salts[rows] ^ np.where(before[high] > before[low], mixed(numbers.of(before[low], before[high])), np.uint64(0))
    at, key_of = _stretches(begin[low], end[high - 1])
    letters = f[at]
    kept = letters != 32
    letters, key_of = pair_folded(letters[kept], key_of[kept])
    sizes = np.bincount(key_of, minlength=len(rows))
    long = sizes >= MIN_KEY
    if not long.all():
        letters = letters[long[key_of]]
    return rows[long], moved[long], stated[long], salt[long], letters, sizes[long]


def whole_hashes(letters: np.ndarray, sizes: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """A hash of each key and its salt."""
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        return mixed(Rolling(mixed((letters.astype(np.uint64) + np.uint64(1)) * STEP)).of(ends - sizes, ends) + salts)


def chunk_fingerprints(letters: np.ndarray, sizes: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each key: hash of the whole, of its first, last and middle chunk, and its letter bag.
    `salts` enter every hash, so equal chunks of two books differ."""
    n, ends = len(letters), np.cumsum(sizes)
    starts = ends - sizes
    line_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - starts[line_of]
    with np.errstate(over="ignore"):
        values = mixed((letters.astype(np.uint64) + np.uint64(1)) * STEP)
        rolled = Rolling(values)
        whole = mixed(rolled.of(starts, ends) + salts)
        power, _ = powers(WINDOW)
        window = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            window[k:] += values[: n - k] * power[k] if n > k else 0
        cut = (mixed(window) >> np.uint64(40)) % np.uint64(CUT_ONE_IN) == 0  # a chunk ends after this place
        first_cut, last_cut = ends.copy(), starts.copy()
        early = np.flatnonzero(cut & (place + 1 >= MIN_CHUNK))
        first_cut[line_of[early][::-1]] = early[::-1] + 1
        late = np.flatnonzero(cut & (place + 1 >= WINDOW) & (ends[line_of] - np.arange(n) - 1 >= MIN_CHUNK))
        last_cut[line_of[late]] = late + 1
        middle_from, middle_to = np.minimum(first_cut, last_cut), np.maximum(first_cut, last_cut)
        chunks = [mixed(rolled.of(a, b) * np.uint64(3) + salts + np.uint64(tag)) for tag, a, b in ((1, starts, first_cut), (2, last_cut, ends), (3, middle_from, middle_to))]
        bins = np.bincount(line_of * 16 + ((values >> np.uint64(20)) % np.uint64(16)).astype(np.int64), minlength=16 * len(sizes))
        bag = (np.minimum(bins, 15).astype(np.uint64).reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64)
    return whole, *chunks, bag


def _keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Parts of the batches with the keys of their lines: the part, row numbers, line_keys."""
    for whole in batches:
        for k in range(0, len(whole), TOGETHER):
            batch = whole.slice(k, TOGETHER)
            books = batch.column("book").dictionary_encode()
            salts = np.array([text_hash(b) for b in books.dictionary.to_pylist()], np.uint64)[books.indices.to_numpy()]
            rows, *made = line_keys(batch.column("text").to_numpy(zero_copy_only=False).tolist(), batch.column("page").to_numpy(), salts)
            yield batch, pa.array(rows, pa.int64()), *made


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows, _, _, salts, letters, sizes in _keys_of(batches):
        made = chunk_fingerprints(letters, sizes, salts)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("item", "page")), *map(_long, made), pa.array(sizes.astype(np.int32))], names=["item", "page", "key", "c1", "c2", "c3", "bag", "n"])


def _whole_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("item", "line_id", "region_id", "book", "page")
    for batch, rows, moved, stated, salts, letters, sizes in _keys_of(batches):
        number = pa.array(moved.astype(np.int32), mask=~stated)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in names), number, _long(whole_hashes(letters, sizes, salts))], names=[*names, "moved", "key"])


def _with_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows, _, _, salts, letters, sizes in _keys_of(batches):
        text, ends = letters.astype(np.uint32).tobytes().decode("utf-32-le"), np.cumsum(sizes).tolist()
        cut = [text[b - n : b] for b, n in zip(ends, sizes.tolist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("wanted", "cluster")), _long(whole_hashes(letters, sizes, salts)), pa.array(cut, pa.string())], names=["wanted", "cluster", "key", "letters"])


def line_texts(lines: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """(item, line_id, region_id, book, page, text): recognised lines and, marked as `item`, the lines of paragraph items
    of several lines, with the item's id for the line's and their number for the region's."""
    known = "line_id is not null and book is not null and page is not null and text is not null"
    out = lines.select(F.lit(False).alias("item"), "line_id", "region_id", "book", F.col("page").cast("int").alias("page"), "text").where(known)
    if items is None:
        return out
    several = items.where("type = 'para' and not coalesce(standalone, false)").where(F.col("text").contains("\n"))
    each = several.select(F.lit(True).alias("item"), F.col("item_id").alias("line_id"), "book", F.col("page").cast("int").alias("page"), F.posexplode(F.split("text", "\n")).alias("k", "text"))
    return out.unionByName(each.select("item", "line_id", F.col("k").cast("long").alias("region_id"), "book", "page", "text").where(known))


def bag_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters by which two letter bags differ."""
    out = np.zeros(len(a), np.int64)
    for k in range(0, 64, 4):
        out += np.abs((a >> k & 15) - (b >> k & 15))
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, weight, key, bag), sorted by chunk and in it by weight and key, the largest first: each line that its
    chunk's first row, if that has a weight, may be the centre of. Nothing of a chunk but its centre is kept in memory."""
    chunk = centre = None
    for batch in batches:
        if not len(batch):
            continue
        chunks, weight, key, bag = (batch.column(c).to_numpy() for c in ("chunk", "weight", "key", "bag"))
        begins = np.concatenate([[True], chunks[1:] != chunks[:-1]])
        goes_on = chunk is not None and chunks[0] == chunk
        first = np.maximum.accumulate(np.where(begins, np.arange(len(chunks)), 0))
        heaviest, cluster, middle = weight[first], key[first], bag[first]
        if goes_on:
            same = first == 0
            heaviest[same], cluster[same], middle[same] = centre
        chunk, centre = chunks[-1], (heaviest[-1], cluster[-1], middle[-1])
        likely = np.flatnonzero((heaviest > 0) & ((weight == 0) | (key == cluster)))
        near = likely[(key[likely] == cluster[likely]) | (bag_distance(bag[likely], middle[likely]) <= MAX_LETTER_CHANGES)]
        yield pa.RecordBatch.from_arrays([pa.array(x[near]) for x in (key, heaviest, cluster)], names=["key", "rows", "cluster"])


def _chunks(n: Column, weight: Column) -> Column:
    """A line's chunks together with a length class, and a weight."""
    of_length = F.floor(n / LENGTH_STEP) * 1000003
    return F.array(*(F.struct(F.col(c).bitwiseXOR(of_length).alias("chunk"), weight.alias("weight")) for c in ("c1", "c2", "c3")))


def centres(prints: DataFrame) -> DataFrame:
    """(key, cluster): each folded line with the commonest line of its chunks that its letters may be a misread copy of.

    Lines on two pages or more are possible centres; under each chunk they stand with their number of rows as weight."""
    page = F.when(~F.col("item"), F.col("page"))
    keys = prints.groupBy("key", "c1", "c2", "c3", "bag", "n").agg(F.count(page).alias("rows"), F.min(page).alias("low"), F.max(page).alias("high"))
    n = F.col("n")
    central = F.array_distinct(F.concat(_chunks(n - LENGTH_SLACK, F.col("rows")), _chunks(n + LENGTH_SLACK, F.col("rows"))))
    own = _chunks(n, F.lit(0).cast("long"))
    roles = keys.select("key", "bag", F.explode(F.when(F.col("low") < F.col("high"), F.concat(own, central)).otherwise(own)).alias("role")).select("role.chunk", "role.weight", "key", "bag")
    placed = roles.repartition("chunk").sortWithinPartitions("chunk", F.desc("weight"), F.desc("key"))
    near = placed.mapInArrow(_gathered, "key long, rows long, cluster long")
    return near.groupBy("key").agg(F.max(F.struct("rows", "cluster")).alias("centre")).select("key", "centre.cluster")


def _on_pages(members: DataFrame, min_pages: int) -> DataFrame:
    """(cluster): those whose lines stand on so many pages."""
    return members.where(~F.col("item")).groupBy("cluster", "page").agg(F.lit(1).alias("one")).groupBy("cluster").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages).select("cluster")


def misfits(members: DataFrame, texts: DataFrame, min_pages: int) -> DataFrame:
    """(key, cluster): folded lines that differ from their centre in more than two misread spots, by edit distance."""
    likely = members.join(_on_pages(members, min_pages), "cluster", "left_semi")
    sample = checkpointed(likely.groupBy("cluster", "key").agg(F.min(F.struct("item", "line_id", "region_id")).alias("at")).select("cluster", F.col("key").alias("wanted"), "at.*"))
    looked_up = F.broadcast(sample) if sample.count() <= BROADCAST_ROWS else sample
    found = texts.alias("t").join(looked_up.alias("s"), F.expr("t.item = s.item and t.line_id = s.line_id and t.region_id <=> s.region_id")).select("s.cluster", "s.wanted", "t.book", "t.page", "t.text")
    letters = checkpointed(found.mapInArrow(_with_letters, LETTERS).where("key = wanted").groupBy("cluster", "key").agg(F.max("letters").alias("letters")))
    heads = letters.where("key = cluster").select("cluster", F.col("letters").alias("head"))
    return letters.where("key <> cluster").join(heads, "cluster", "left").where(F.coalesce(F.levenshtein("letters", "head", MAX_EDITS), F.lit(-1)) < 0).select("key", "cluster")


def repeated_lines(lines: DataFrame, regions: DataFrame, books: DataFrame, min_pages: int = MIN_PAGES, items: DataFrame | None = None) -> DataFrame:
    """(item, line_id, region_id, cluster): lines that stand on `min_pages` or more different pages of their book;
    cluster is the fingerprint of the line that they were gathered round. With `items` also the lines of paragraph items that
    are such lines (line_id is the item's id, region_id the line's number in it); they do not count for pages.

    Rows delivered twice count once; regions of kind table are left out, lines without a known region are not.
    A number at either end is taken off only where it is the page's printed number, of an item also one of the two after
    it; where a book's offset is null or unknown, numbers are content. Null texts, ids, books and pages are no cases.
    Empty tables give none."""
    texts = line_texts(lines, items)
    near = centres(texts.mapInArrow(_fingerprint, FINGERPRINTS))
    offsets = books.select("book", F.col("page_number_offset").alias("offset")).where("offset is not null and book is not null").groupBy("book").agg(F.min("offset").alias("offset"))
    tables = regions.where("kind = 'table' and region_id is not null").select("region_id", F.lit(False).alias("item")).distinct()
    members = checkpointed(
        texts.mapInArrow(_whole_lines, WHOLE)
        .join(near, "key")
        .join(offsets, "book", "left")
        .where("moved is null or moved = offset or item and moved between offset and offset + 2")
        .join(tables, ["region_id", "item"], "left_anti")
        .select("item", "line_id", "region_id", "page", "key", "cluster")
    )
    kept = members.join(misfits(members, texts, min_pages), ["key", "cluster"], "left_anti")
    kept = kept.join(_on_pages(kept, min_pages), "cluster", "left_semi")
    line = [F.col("item"), F.col("line_id"), F.when(F.col("item"), F.col("region_id")).alias("k")]
    return kept.groupBy(*line).agg(F.min("cluster").alias("cluster"), F.min("region_id").alias("region_id")).select("item", "line_id", "region_id", "cluster")


def without_repeated_lines(lines: DataFrame, regions: DataFrame, books: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(book, page, text, cut): the text of each page without the lines that its book repeats, in the order of regions and
    lines, and how many lines were cut. Lines without text or a place in a book are left out, a page of nothing but
    repeated lines has an empty text. Only the lines of one page are brought together."""
    found = repeated_lines(lines, regions, books, min_pages).select("line_id", F.lit(True).alias("_cut"))
    places = regions.where("region_id is not null").groupBy("region_id").agg(F.min("id").alias("_ord"))
    once = lines.where("line_id is not null and book is not null and page is not null and text is not null").select("line_id", "region_id", "book", "page", "line_no", "text", "read_at")
    once = once.groupBy("line_id").agg(F.max_by(F.struct("region_id", "book", "page", "line_no", "text"), F.struct("read_at", "text")).alias("l")).select("line_id", "l.*")
    placed = once.join(found, "line_id", "left").join(places, "region_id", "left")
    shown = F.when(F.col("_cut").isNull(), F.struct("_ord", "region_id", "line_no", "line_id", "text"))
    return placed.groupBy("book", "page").agg(F.sort_array(F.collect_list(shown)).alias("_l"), F.count("_cut").alias("cut")).select("book", "page", F.array_join(F.col("_l.text"), "\n").alias("text"), "cut")
