from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.llm import p3_quality as p3
from pagewright.llm import p5_repair as p5
from pagewright.llm import p7_mixing as p7
from pagewright.llm.codes import code_points
from pagewright.llm.p6_packing import fill_report, packed, packing_rules
from pagewright.llm.p8_levels import LevelModels, reading_levels
from pagewright.llm.streams import region_blocks

DOCUMENTS = "doc_id long, text string, lang string, source string"


def best_fit_decreasing(sizes, capacity):
    room = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= size]
        at = min(fits, key=lambda i: room[i]) if fits else None
        if at is None:
            room.append(capacity)
            at = len(room) - 1
        room[at] -= size
    return sorted(room)


def test_rules_are_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([7, 20, 64, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 90))]
        histogram = Counter(sizes)
        rules, n = packing_rules(histogram, capacity)
        room = [capacity] * n
        for size, count in histogram.items():
            own = [r for r in rules if r[0] == size]
            for rank in range(count):
                _, start, first, each = [r for r in own if r[1] <= rank][-1]
                room[first + (rank - start) // each] -= size
        assert sorted(room) == best_fit_decreasing(sizes, capacity)


def test_packing(spark):
    rows = [(i, "szó " * n, "hun", "s") for i, n in enumerate([1, 5, 40, 200, 3, 3])] + [(10, None, "hun", "s"), (11, "", "hun", "s"), (None, "x", "hun", "s")]
    df = spark.createDataFrame(rows, DOCUMENTS).withColumn("part", F.lit("clash")).withColumn("size", F.lit(1))
    packs = spark.createDataFrame([("a", 64), ("b", 256), ("b", 512), (None, 5), ("c", 0)], "pack string, capacity int")
    made = packed(df, packs).collect()
    assert {r.pack for r in made} == {"a", "b"} and {r.capacity for r in made} == {64, 512}
    assert {r.doc_id for r in made} == {0, 1, 2, 3, 4, 5, 10, 11}
    fill = Counter()
    for r in made:
        fill[r.pack, r.container] += r.n_tokens
    assert all(fill[p, c] <= {"a": 64, "b": 512}[p] for p, c in fill)
    split = {r.doc_id for r in made if r.part > 0}
    whole = Counter()
    for r in made:
        whole[r.pack, r.doc_id] += r.n_tokens
    assert split == {d for (p, d), n in whole.items() if n > {"a": 64, "b": 512}[p]}
    assert fill_report(packed(df, packs)).count() == 2
    assert packed(df.limit(0), packs).count() == 0 and packed(df, packs.limit(0)).count() == 0


def test_routes_share_overlapping_sources():
    flows = p7.routes({("a",): 100, ("a", "b"): 60, ("b",): 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2}, 140)
    got = Counter()
    for (_, source), n in flows.items():
        got[source] += n
    assert got == {"a": 70, "b": 70}
    assert p7.largest_total({("a",): 100, ("b",): 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2}) in (40, 41)  # quotas are rounded
    assert p7.largest_total({}, {"a": 1.0}, {"a": 1}) == 0


def brute_most(patterns, shares, repeats, total):
    """Largest flow by single augmenting paths."""
    net = {}
    for p, t in patterns.items():
        net["in", p] = t * max(repeats[s] for s in p)
    room = dict(net) | {(p, s): t * repeats[s] for p, t in patterns.items() for s in p} | {(s, "out"): round(x * total) for s, x in shares.items()}
    for (a, b) in list(room):
        room.setdefault((b, a), 0)
    sent = 0
    while True:
        by, waiting = {"in": None}, ["in"]
        for a in waiting:
            for (x, b), r in room.items():
                if x == a and r and b not in by:
                    by[b] = a
                    waiting.append(b)
        if "out" not in by:
            return sent
        path, at = [], "out"
        while by[at] is not None:
            path.append((by[at], at))
            at = by[at]
        amount = min(room[e] for e in path)
        for a, b in path:
            room[a, b] -= amount
            room[b, a] += amount
        sent += amount


def test_routes_are_a_largest_flow_at_least_cost():
    rng = random.Random(8)
    for _ in range(60):
        names = "abcd"[: rng.randint(1, 4)]
        repeats = {s: rng.randint(1, 3) for s in names}
        patterns = {}
        for _ in range(rng.randint(1, 6)):
            patterns[tuple(sorted(rng.sample(names, rng.randint(1, len(names)))))] = rng.randint(1, 40)
        shares = {s: 1 / len(names) for s in names}
        total = rng.randint(0, 150)
        flows = p7.routes(patterns, shares, repeats, total)
        most = brute_most(patterns, shares, repeats, total)
        assert sum(flows.values()) == most
        assert p7.reaches(patterns, shares, repeats, total) == (most == sum(round(x * total) for x in shares.values()))
        for p, t in patterns.items():
            assert sum(n for (q, _), n in flows.items() if q == p) <= t * max(repeats[s] for s in p)
            assert all(n <= t * repeats[s] for (q, s), n in flows.items() if q == p)
    # no second use where a first one does
    assert p7.routes({("a",): 10, ("b",): 10, ("a", "b"): 10}, {"a": 0.5, "b": 0.5}, {"a": 2, "b": 2}, 30) in ({(("a",), "a"): 10, (("b",), "b"): 10, (("a", "b"), "a"): 5, (("a", "b"), "b"): 5},)


def test_thousands_of_patterns():
    rng = random.Random(9)
    names = [f"s{k:02d}" for k in range(20)]
    patterns = {}
    while len(patterns) < 6000:
        patterns[tuple(sorted(rng.sample(names, rng.randint(1, 6))))] = rng.randint(1, 1000)
    repeats, shares = {s: rng.randint(1, 3) for s in names}, {s: 1 / 20 for s in names}
    total = p7.largest_total(patterns, shares, repeats)
    assert sum(p7.routes(patterns, shares, repeats, total).values()) == sum(round(x * total) for x in shares.values()) and not p7.reaches(patterns, shares, repeats, total + 40)


def test_fill_never_exceeds():
    rng = random.Random(1)
    for _ in range(100):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(0, 30))]
        needs = [("a", rng.randint(0, 300), rng.randint(1, 3)), ("b", rng.randint(0, 300), 1)]
        made = p7.fill(sizes, needs)
        for source, tokens, times in needs:
            assert sum(sizes[i] * n for i, s, n in made if s == source) <= tokens
            assert all(n <= times for i, s, n in made if s == source)


@pytest.mark.parametrize("bucket", [2000, 30, 3])
def test_mixture(spark, monkeypatch, bucket):
    monkeypatch.setattr(p7, "BUCKET_TEXTS", bucket)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alma", "körte", "szilva"]) + str(i) for _ in range(rng.randint(3, 30))), "hun", "ab"[i % 2]) for i in range(400)]
    rows += [(1000 + i, rows[i][1], "hun", "b") for i in range(0, 20, 2)] + [(5000, "x", "hun", None), (5001, None, "hun", "a"), (None, "y", "hun", "a"), (5002, "z", "hun", "other")]
    targets = spark.createDataFrame([("a", 0.7, 1), ("b", 0.2, 2), ("empty", 0.1, 3), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(rows, DOCUMENTS)
    made = p7.mixture(df, targets).collect()
    of = Counter()
    for r in made:
        of[r.source] += r.repeats * r.n_tokens
    total = sum(of.values())
    assert abs(of["a"] / total - 7 / 9) < 0.02 and abs(of["b"] / total - 2 / 9) < 0.02
    assert all(r.repeats <= {"a": 1, "b": 2}[r.source] for r in made)
    texts = {i: t for i, t, _, _ in rows}
    assert max(Counter(texts[r.doc_id] for r in made).values()) <= 2
    assert {(r.source, r.doc_id) for r in p7.mixture(df, targets).collect()} == {(r.source, r.doc_id) for r in made}
    shares = {r.source: r.share for r in p7.shares_reached(p7.mixture(df, targets), targets).collect()}
    assert shares["empty"] == 0 and set(shares) == {"a", "b", "empty"}
    assert p7.mixture(df.limit(0), targets).count() == 0 and p7.mixture(df, targets.limit(0)).count() == 0


def test_levels(spark):
    rng = random.Random(4)
    plain, learned = "kutya ház fut megy szép".split(), "megkérdőjelezhetetlen átláthatatlanság intézményesült fogalomrendszer".split()

    def text(share, length):
        return "\n\n".join(" ".join(rng.choice(learned if rng.random() < share else plain) for _ in range(length)) + "." for _ in range(4))

    rows = [(i, text((i % 4) / 4, 6 + 5 * (i % 4)), "hun", "s") for i in range(120)]
    labels = spark.createDataFrame([(i, "r", i % 4 + 1) for i in range(40)] + [(1, "q", 9), (None, "q", 1)], "doc_id long, rater string, level int")
    more = [(500, None, "hun", "s"), (501, "", "eng", "s"), (502, "szöveg", None, "s"), (503, "text", "jpn", "s"), (None, "x", "hun", "s")]
    df = spark.createDataFrame(rows + more, DOCUMENTS).withColumn("level", F.lit("clash"))
    lexicon = spark.createDataFrame([("kutya", "hun"), (None, "hun"), ("dog", None)], "word string, lang string")
    made = {r.doc_id: r.level for r in reading_levels(df, labels, lexicon).collect()}
    assert sum(made[i] == i % 4 + 1 for i in range(40, 120)) / 80 >= 0.9
    assert made[500] is None and made[501] is None and not {502, 503} & made.keys()
    assert reading_levels(df.limit(0), labels, lexicon).count() == 0 and reading_levels(df, labels.limit(0), lexicon).count() == 122
    assert np.isfinite(LevelModels([]).tables["hun"]).all()


def counts_of(texts, common=(), lang="hun"):
    _, codes, lengths = code_points(texts)
    p3._CHARS.meet(codes)
    known = []
    for word in common:
        _, c, _ = code_points([word])
        p3._CHARS.meet(c)
        known.append(int(p3.word_keys(p3.word_hashes(c, p3._CHARS["kind"][c])[2], p3.lang_numbers([lang]))[0]))
    return p3.text_counts(codes, lengths, np.sort(np.array(known, np.uint64)), p3.lang_numbers([lang] * len(texts)))


def test_text_counts():
    names = dict(zip(p3.COUNTS, counts_of(["A kutya fut, a ház.\n12. új", "", "| | ~ ;;", "Te​st"], ["a"]).T))
    assert list(names["lines"]) == [2, 0, 1, 1] and list(names["words"]) == [7, 0, 0, 1]
    assert list(names["commas"]) == [1, 0, 2, 0] and list(names["ends"]) == [2, 0, 0, 0] and list(names["numbers"]) == [1, 0, 0, 0]
    assert list(names["common"])[0] == 2 and list(names["listed"])[0] == 1
    assert dict(zip(p3.COUNTS, counts_of(["кожух Коcпиcко Ωμέγα"]).T))["greek"][0] == 5


def test_common_words_come_from_the_corpus(spark, tables):
    lines = tables.lines([(i, "b", 1, 1, i, "a szép kutya és a ház") for i in range(5)] + [(9, "j", 1, 2, 0, "村の中の人"), (10, None, 1, 3, 0, None)])
    made = p3.common_words(lines, tables.items([]), tables.books([("b", "hun", 0), ("j", "jpn", 0)]), top=1)
    assert len(made) == 2
    assert dict(zip(p3.COUNTS, counts_of(["a kutya"]).T))["common"][0] == 0
    _, codes, lengths = code_points(["a kutya", "の村の"])
    both = p3.text_counts(codes, lengths, made, p3.lang_numbers(["hun", "jpn"]))
    assert list(both[:, p3.COUNTS.index("common")]) == [1, 2]
    assert len(p3.common_words(tables.lines([]), tables.items([]), tables.books([]))) == 0


def test_tails_are_exact_ranks(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b"]), [rng.randint(0, 6) for _ in range(2)]) for _ in range(300)]
    counts = spark.createDataFrame(rows, "lang string, stats array<int>").select("lang", F.posexplode("stats").alias("stat", "level")).groupBy("lang", "stat", "level").agg(F.count("*").alias("n"))
    made = {(r.lang, r.stat, r.level): (r.below, r.above) for r in p3.exact_tails(counts).collect()}
    for lang in "ab":
        own = [s for x, s in rows if x == lang]
        for stat in (0, 1):
            for level in {s[stat] for s in own}:
                assert made[lang, stat, level] == (sum(s[stat] <= level for s in own) / len(own), sum(s[stat] >= level for s in own) / len(own))


def test_not_prose(spark, tables):
    rng = random.Random(8)
    prose = lambda: " ".join("a szép kutya fut és a régi ház áll mert az út hosszú".split()[rng.randint(0, 4) :]) + ". Az öreg ló megy."
    junk = lambda: " ".join("".join(rng.choice("bcdfgk") for _ in range(5)) for _ in range(12))
    rows = [(i, "b", 1, prose() if i % 5 else junk(), False) for i in range(200)] + [(900, "b", 1, None, False), (901, "c", 1, "", False), (902, "b", 1, junk(), True)]
    labels = spark.createDataFrame([("item", i, "prose" if i % 5 else "junk") for i in range(40)], "tbl string, id long, form string")
    made = p3.not_prose(tables.lines([]), tables.regions([]), tables.items(rows), tables.books([("b", "hun", 0)]), labels).collect()
    assert {r.id for r in made} == {i for i in range(0, 200, 5)}


LEXICON = "a az szép kutya háza megy fáradt asszony összeg amikor nehéz hideg tűz ment közeli erős vár út mert öreg".split()


def hungarian(extra=()):
    return p5.Lexicon({"hun": set(LEXICON) | set(extra), "eng": set()})


def test_decode():
    lexicon = hungarian()
    found = p5.decoded_texts(["A fá-", "radt kutya, ami¬,", "kor az asz-", "szony a nchéz ház. A hi", "deg tűz. A szép-", "Kutya ment a kő- és", "hideq vár"], lexicon, "hun")
    assert sorted((i, f, w) for i, f, _, w in found.faults) == [(0, "hyphen", "fáradt"), (1, "hyphen", "amikor"), (2, "hyphen", "asszony"), (3, "hyphen", "hideg"), (3, "misread", "nehéz"), (6, "misread", "hideg")]
    assert p5.decoded_texts([], lexicon, "hun").faults == [] and p5.decoded_texts(["…"], lexicon, "hun", True).tails == {}
    ends = p5.decoded_texts(["radt kutya és a", "nehéz fá-"], lexicon, "hun", True)
    assert ends.heads == {0: (0, "radt")} and ends.tails == {0: (1, "fá", "-")}
    assert p5.cased("hideg", "Hldeg") == "Hideg" and p5.cased("hideg", "HIDFG") == "HIDEG"
    assert p5.repaired_text(["A fáradt ku-", "tya ment."], lexicon, "hun") == ["A fáradt kutya ment."]


def test_paths_over_the_lattice():
    words = hungarian(["kis", "nagy", "kisnagy", "és"]).of["hun"]
    best = lambda *tokens, between=" ": [text for _, _, text in words.best(tokens, (between,) * (len(tokens) - 1))]
    assert best("kis", "nagy") == ["kis", "nagy"] and best("kis", "nagy", between="-") == ["kisnagy"] and best("kis", "nagy", between="") == ["kis", "nagy"]
    assert best("fárad", "t") == ["fáradt"] and best("fár", "adt", between="") == ["fáradt"] and best("fár", "adt", between=" –") == ["fáradt"]
    assert best("ház", "Fár", between="-") == ["ház", "Fár"] and best("szép", "háza", between=" –") == ["szép", "háza"]
    assert best("szépkutya") == ["szép kutya"] and best("nchéz") == ["nehéz"] and best("xqzvw") == ["xqzvw"]
    assert best("nch", "éz", between="-") == ["nehéz"] and best("asz", "szony", between="­") == ["asszony"] and best() == []
    assert best("kő", "és", between="-") == ["kő", "és"]


def brute_tokens(text):
    return [m.span() for m in p5._WORD.finditer(text)]


def test_tokens_are_those_of_the_pattern():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "é", "ő", "1", " ", "-", "‐", "\u0301", "\u2060", "_", ".", "Z", "̈"]) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    _, codes, lengths = code_points(texts)
    t = p5.tokens_of(codes, lengths)
    begin = np.cumsum(lengths + 1) - lengths - 1
    made = [[] for _ in texts]
    for a, b, k in zip(t.begin, t.end, t.line):
        made[k].append((int(a - begin[k]), int(b - begin[k])))
    assert made == [brute_tokens(x) for x in texts]
    _, codes, lengths = code_points(["Éhes kutya"])
    t = p5.tokens_of(codes, lengths)
    assert int(t.hashes[0]) == p5.word_hash("éhes")


def test_regions_are_whole_in_every_block():
    rng = random.Random(5)
    rows = sorted((rng.randint(0, 12), rng.randint(0, 60)) for _ in range(200))
    names = ["region_id", "line_no", "line_id", "text", "out", "kind", "lang", "book", "page", "ord", "offset"]
    table = pa.table({n: c for n, c in zip(names, ([r for r, _ in rows], [i for _, i in rows], [i for _, i in rows], [f"t{i}" for _, i in rows], [False] * 200, ["text"] * 200, ["hun"] * 200, ["b"] * 200, [1] * 200, [0] * 200, [0] * 200))})
    for size in (1, 3, 17, 500):
        got = [(b.facts["region_id"][r], int(i), t) for b in region_blocks(table.to_batches(size)) for r, i, t in zip(b.region, b.line_ids, b.texts)]
        assert got == [(r, i, f"t{i}") for r, i in sorted(set(rows))]
        seen = [r for b in region_blocks(table.to_batches(size)) for r in b.facts["region_id"]]
        assert len(seen) == len(set(seen))
    assert list(region_blocks(iter([table.to_batches()[0].slice(0, 0)]))) == []


def test_paragraph_starts_at_least_cost():
    lines = ["Az öreg kutya megy a hosszú úton és", "a ház elé ér.", "Másnap a nehéz hideg vár és az erős", "tűz ég a közeli dombon, amikor jön", "a reggel."]
    assert p5.paragraph_starts(lines) == [0, 2] and p5.paragraph_starts([]) == []


def test_faults(spark, tables):
    rng = random.Random(9)
    text = lambda: " ".join(rng.choice(LEXICON) for _ in range(11))
    rows, regions, k = [], [], 0
    for page in range(1, 9):
        regions += [(page * 10, "b", page, 0, "header"), (page * 10 + 1, "b", page, 1, "text")]
        rows += [(k := k + 1, "b", page, page * 10, 0, "A tengeri út könyve"), (k := k + 1, "b", page, page * 10, 1, f"– {page + 3} –")]
        rows += [(k := k + 1, "b", page, page * 10 + 1, n, t) for n, t in enumerate([text(), text(), "a szép kutya és a nchéz fá-" if page == 2 else text(), "végül"][: 3 if page == 2 else 4])]
    rows.append((999, "b", 3, 31, -1, "radt kutya ment."))
    items = tables.items([(1, "b", 9, "A szép ku-\nA tengeri út könyve | 12\ntya megy.\n12", False), (2, "b", 9, None, False)])
    lexicon = spark.createDataFrame([(w, "hun") for w in LEXICON] + [(None, "hun")], "word string, lang string")
    labels = spark.createDataFrame([], "tbl string, id long, form string")
    made = {(r.tbl, r.id, r.fault, r.fixed) for r in p5.faults(tables.lines(rows), tables.regions(regions), tables.books([("b", "hun", 3)]), items, lexicon, labels).collect()}
    heads = {(("line"), i, "furniture", "") for i, _, _, r, _, _ in rows if r % 10 == 0}
    cut = next(i for i, _, _, _, _, t in rows if t.endswith("fá-"))
    assert made == heads | {("line", cut, "hyphen", "fáradt"), ("line", cut, "misread", "nehéz"), ("item", 1, "hyphen", "kutya"), ("item", 1, "furniture", "")}


def test_paragraphs_go_on_over_regions_and_pages(spark, tables):
    rows = [
        (1, "b", 1, 11, 0, "A szép kutya és a nchéz ház,"), (2, "b", 1, 11, 1, "a kutya ment a fá-"), (3, "b", 1, 12, 0, "radt ház és a szép"), (4, "b", 2, 21, 0, "kutya ment."),
        (5, "b", 2, 22, 0, "A szép kutya ment a ház és a kutya,"), (6, "b", 2, 22, 1, "a nehéz."), (7, "b", 2, 23, 0, "a sáv"), (8, "g", 1, 31, 0, "Ο μικρός κήπος"), (9, "g", 2, 32, 0, "είναι εδώ."), (9, "g", 2, 32, 0, "είναι εδώ."),
    ]
    regions = [(11, "b", 1, 0, "text"), (12, "b", 1, 1, "text"), (21, "b", 2, 0, "text"), (22, "b", 2, 1, "text"), (23, "b", 2, 2, "sidebar"), (31, "g", 1, 0, "text"), (32, "g", 2, 0, "text")]
    items = tables.items([(1, "b", 9, "A szép ku-\ntya és a nchéz\nház.", False), (2, "g", 9, "Ο κήπος\nεδώ.", False), (3, "b", 9, None, False), (4, "b", 9, "A ház.", True)])
    lexicon = spark.createDataFrame([(w, "hun") for w in LEXICON], "word string, lang string")
    labels = spark.createDataFrame([], "tbl string, id long, form string")
    made = p5.repaired_paragraphs(tables.lines(rows), tables.regions(regions), tables.books([("b", "hun", 3), ("g", "ell", 0)]), items, lexicon, labels).collect()
    assert sorted((r.book, r.page, r.region_id or 0, r.item_id or 0, r.par_no, r.text) for r in made) == [
        ("b", 1, 11, 0, 0, "A szép kutya és a nehéz ház, a kutya ment a fáradt ház és a szép kutya ment."),
        ("b", 2, 22, 0, 0, "A szép kutya ment a ház és a kutya, a nehéz."),
        ("b", 2, 23, 0, 0, "a sáv"),
        ("b", 9, 0, 1, 0, "A szép kutya és a nehéz ház."),
        ("g", 1, 31, 0, 0, "Ο μικρός κήπος είναι εδώ."),
        ("g", 9, 0, 2, 0, "Ο κήπος εδώ."),
    ]


def test_right_words_stay_in_paragraphs(spark, tables):
    rows = [(n, "b", n, n, 0, "A szép kutya és a nchéz ház.") for n in range(1, 6)]
    regions = [(n, "b", n, 0, "sidebar") for n in range(1, 6)]
    lexicon = spark.createDataFrame([(w, "hun") for w in LEXICON], "word string, lang string")
    made = p5.repaired_paragraphs(tables.lines(rows), tables.regions(regions), tables.books([("b", "hun", 3)]), tables.items([]), lexicon, spark.createDataFrame([], "tbl string, id long, form string")).collect()
    assert [r.text for r in made] == ["A szép kutya és a nchéz ház."] * 5


def test_confusions_that_make_a_pair():
    pairs = {"eng": [("iight", "light"), ("intelligibiiity", "intelligibility")], "fra": [("iivre", "livre"), ("iives", "lives")], "hun": [("távoii", "távoli"), ("közeii", "közeli"), ("örege", "öreg")], "deu": [("schiief", "schlief"), ("rnarkt", "markt")]}
    for lang, of in pairs.items():
        words = p5.Words(lang, {w for _, w in of})
        assert [words.repair(seen) for seen, _ in of] == [None if seen == "örege" else w for seen, w in of]
    assert p5.Words("eng", {"corn", "torn"}).repair("com") == "corn" and p5.confusion_cost("bor", "bon") > p5.MOST_EDITS


def test_short_words():
    found = p5.decoded_texts(["A vár es a ház áll, a k6 is, II. Béla Yso\u2060sáp\ufeffo és Hexa-o, Eixa\u0301o\u0301p úr, szép"], hungarian(["és", "kő"]), "hun").faults
    assert [(token, fixed) for _, kind, token, fixed in found if kind == "misread"] == [("es", "és"), ("k6", "kő")]


def test_page_numbers():
    assert p5.is_page_number("– 17 –", 12, 5) and p5.is_page_number("xvii", 12, 5) and p5.is_page_number("I7", 12, 5) and p5.is_page_number("17" + " " * 60, 12, 5)
    assert not p5.is_page_number("18", 12, 5) and p5.is_page_number("18", 12, 5, 2) and not p5.is_page_number("17", 12, None) and not p5.is_page_number("17 szó", 12, 5)
