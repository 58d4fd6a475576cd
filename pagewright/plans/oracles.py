"""The SQL that the core's queries must agree with, over the same tables."""

from __future__ import annotations

LINES = "(SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY read_at DESC NULLS LAST, text) AS n FROM ocr_lines) WHERE n = 1)"
REGIONS = "(SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY score DESC NULLS LAST, id) AS n FROM regions) WHERE n = 1)"
SMALL = "a-záéíóöőúüű"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _clean(x: str) -> str:
    for one, letters in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        x = f"replace({x}, '{one}', '{letters}')"
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    return rf"regexp_replace({_strip(x)}, '^[*.,:;]+\s*([{SMALL}])', '\1')"


_ENDS = "[.!?…:;][\"''”’»)\\]]*$"
_BULLET = "^[•·▪■◆●○‣*]"
_ITEM = "^([-–—]\\s|[0-9]{1,3}[.)]\\s|[a-z][.)]\\s)"


def ends(x: str) -> str:
    return f"coalesce(regexp_matches({_strip(x)}, '{_ENDS}'), false)"


def bullet(x: str) -> str:
    return f"coalesce(regexp_matches({_strip(x)}, '{_BULLET}'), false)"


def item(x: str) -> str:
    return rf"coalesce(regexp_matches(regexp_replace({x}, '^[\s\p{{Z}}]+', ''), '{_ITEM}'), false)"


_W, _H = "greatest(0.0, b.x1 - b.x0)", "greatest(0.0, b.y1 - b.y0)"
_COMMON = "(greatest(0.0, least(b.x1, c.x1) - greatest(b.x0, c.x0)) * greatest(0.0, least(b.y1, c.y1) - greatest(b.y0, c.y0)))"
_OVERLAP = f"CASE WHEN {_W} * {_H} = 0 THEN 0.0 ELSE {_COMMON} / ({_W} * {_H}) END"
_NESTED = f"""nested AS (
    SELECT book, page, id, kind, box.x0 AS x0, box.y0 AS y0, box.x1 AS x1, box.y1 AS y1 FROM {REGIONS}
    UNION ALL SELECT book, page, id + 100, kind, box.x0 + 2, box.y0 + 2, box.x1 - 2, box.y1 - 2 FROM {REGIONS} WHERE region_id % 7 = 0
    UNION ALL SELECT book, page, id + 200, kind, box.x0 + 3, box.y0 + 3, box.x1 - 3, box.y1 - 3 FROM {REGIONS} WHERE region_id % 77 = 0)"""
_WORDS = f"""words AS (
    SELECT line_id, k - 1 AS word_no, parts[k] AS word, (((k - 1) * 37 + length(parts[k]) * 11) % 100 - 3)::DOUBLE AS conf
    FROM (SELECT line_id, string_split(text, ' ') AS parts FROM {LINES}), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS k)),
    kept AS (SELECT * FROM words WHERE trim(word) <> '' AND conf >= 0 AND (conf >= 30 OR regexp_matches(word, '\\p{{Nd}}')))"""
_AT_ENDS = "'a','s','e','é','ó','ő','A','S','É','Ó','Ő','—','–','-'"
_SHORT = ", ".join(f"'{w}'" for w in "a az s és is ez e ha le be ki ne se el ő ők én te mi ti ma no jó fő kő ló tó új év út id pl km kp tp ép -- – — -".split())
_TEXT_LINES = f"text_lines AS (SELECT l.region_id, l.line_no, coalesce(l.text, '') AS text, l.box, l.par FROM {LINES} l JOIN {REGIONS} r USING (region_id) WHERE r.kind IN ('text', 'sidebar'))"


def _breaks(geometry: str, hanging: bool = False, lines: str = _TEXT_LINES, more: str = "") -> str:
    """Paragraph breaks; `geometry` is the condition under which boxes count."""
    entry = "AND true" if hanging else "AND false"
    return f"""WITH {lines},
    seen AS (SELECT *, lag(text) OVER o AS prev, lag(box) OVER o AS pbox, lag(par) OVER o AS ppar, count(*) OVER r AS n, count(box) OVER r AS boxes, row_number() OVER o AS k
        FROM text_lines WINDOW o AS (PARTITION BY region_id ORDER BY line_no), r AS (PARTITION BY region_id)),
    sizes AS (SELECT region_id, coalesce(nullif(median(box.y1 - box.y0), 0), 1.0) AS h, coalesce(median(greatest(0.0, box.y0 - pbox.y1)) FILTER (WHERE pbox IS NOT NULL), 0.0) AS g,
        list_sort(list(box.x0)) AS xs, list_sort(list(box.x1)) AS xe, any_value(n) AS n, min(box.x0) FILTER (WHERE k = 1) AS first_x0 FROM seen WHERE box IS NOT NULL GROUP BY region_id),
    marked AS (SELECT s.*, z.h, z.g, z.first_x0, xs[1 + z.n // 10] AS l, xe[1 + (z.n * 9) // 10] AS r FROM seen s LEFT JOIN sizes z USING (region_id))
    SELECT region_id, line_no{more}, CASE WHEN prev IS NULL THEN false
        WHEN {geometry} {entry} AND first_x0 - l < 0.6 * h THEN box.x0 - l < 0.5 * h AND NOT regexp_matches(regexp_replace(prev, '[\\s\\p{{Z}}]+$', ''), '[-–]$')
        WHEN {bullet("text")} THEN true WHEN NOT {ends("prev")} THEN false WHEN {item("text")} THEN true
        WHEN {geometry} THEN box.y0 - pbox.y1 > greatest(1.8 * g, g + 0.5 * h) OR box.x0 - l > 0.9 * h OR r - pbox.x1 > 2.0 * h
        ELSE par IS DISTINCT FROM ppar END AS breaks FROM marked"""


_L = r"[\p{L}\p{Nl}\p{No}]"
_SUSPENDED = ", ".join(f"'{w}'" for w in ("és", "vagy", "s", "illetve", "valamint", "avagy", "meg", "sem", "ill."))


def _join(a: str, b: str) -> str:
    """Two stripped pieces of running text as one, by the rules for a line's end without a word list."""
    a = f"regexp_replace({a}, '({_L})([-‐¬])(?:[-‐¬–]|\\s?[.,:;]+)+$', '\\1\\2')"
    hyphen, cut, first = f"regexp_matches({a}, '\\p{{L}}[-‐­¬]$')", f"left({a}, length({a}) - 1)", f"lower(regexp_extract({b}, '^([^ ]*)', 1))"
    host = f"regexp_matches({a}, '(?:[0-9][%°]?|(?:^|[^\\p{{L}}\\p{{Nl}}\\p{{No}}])[A-ZÁÉÍÓÖŐÚÜŰ]{{2,5}})[-‐­¬]$')"
    small = f"regexp_matches({b}, '^\\p{{Ll}}')"
    return f"""CASE WHEN {host} AND {small} AND {first} NOT IN ({_SUSPENDED}) THEN {a} || {b} WHEN {hyphen} AND {first} IN ({_SUSPENDED}) THEN {cut} || '- ' || {b}
        WHEN {hyphen} AND {small} THEN {cut} || {b} WHEN {hyphen} THEN {cut} || '-' || {b} ELSE {a} || ' ' || {b} END"""


def _fold(pieces: str) -> str:
    return f"list_reduce({pieces}, lambda a, b: {_join('a', 'b')})"


_CLEANED = f"text_lines AS (SELECT * FROM (SELECT l.region_id, l.line_no, {_clean('l.text')} AS text, l.box, l.par FROM {LINES} l JOIN {REGIONS} r USING (region_id) WHERE r.kind IN ('text', 'sidebar')) WHERE text <> '')"
_PARAGRAPHS = f"""SELECT region_id, par_no, {_fold("list(text ORDER BY line_no)")} AS text, count(*)::INT AS n_lines FROM (
    SELECT *, sum(breaks::INT) OVER (PARTITION BY region_id ORDER BY line_no)::INT AS par_no FROM ({_breaks("boxes = n", lines=_CLEANED, more=", text")})) GROUP BY 1, 2"""
_SINGLE = f"""SELECT region_id, {_fold("list(text ORDER BY line_no)")} AS text FROM (SELECT l.region_id, l.line_no, {_clean('l.text')} AS text FROM {LINES} l JOIN {REGIONS} r USING (region_id) WHERE r.kind IN ('title', 'caption')) WHERE text <> '' GROUP BY 1"""


def _continued(items: str, keys: str) -> str:
    """(keys, seq, type, text): items with paragraphs that go on joined at the place of their first piece."""
    return f"""SELECT {keys}, island AS seq, min_by(type, seq) AS type, {_fold("list(trim(text) ORDER BY seq)")} AS text, count(*) AS n, min_by(text, seq) AS own FROM (SELECT *, max(start) OVER (PARTITION BY {keys}, grp ORDER BY seq) AS island FROM (
        SELECT *, CASE WHEN type = 'para' AND pt = 'para' AND NOT coalesce(standalone, false) AND px <> '' AND text <> '' AND NOT {bullet("text")} AND NOT {ends("px")} THEN NULL ELSE seq END AS start
        FROM (SELECT *, lag(type) OVER o AS pt, lag(text) OVER o AS px FROM {items} WHERE type IN ('para', 'heading') WINDOW o AS (PARTITION BY {keys}, grp ORDER BY seq)))) GROUP BY {keys}, grp, island"""


def _merged(keys: str) -> str:
    """whole: items with paragraphs that go on joined."""
    return f"""joined AS ({_continued("items", keys)}),
        whole AS (SELECT i.* EXCLUDE (text), CASE WHEN j.n > 1 THEN j.text ELSE i.text END AS text FROM items i JOIN joined j ON i.book = j.book AND i.seq = j.seq UNION ALL BY NAME SELECT * FROM items WHERE type NOT IN ('para', 'heading') OR type IS NULL)"""


def _rendered(items: str, keys: str) -> str:
    return f"""p AS (SELECT {keys}, seq, CASE WHEN type <> 'marker' THEN grp END AS g, coalesce(CASE type WHEN 'marker' THEN '<!-- ' || CASE WHEN printed IS NOT NULL AND printed <> page THEN 'page ' || printed || ' (pdf ' || page || ')' ELSE 'page ' || page END || ' -->'
        WHEN 'heading' THEN CASE WHEN grp IS NOT NULL THEN '**' || text || '**' ELSE repeat('#', coalesce(level, 2)) || ' ' || text END WHEN 'caption' THEN '*' || text || '*' ELSE text END, '') AS t FROM {items}),
        s AS (SELECT *, g IS NOT NULL AND g IS NOT DISTINCT FROM lag(g) OVER (PARTITION BY {keys} ORDER BY seq) AS same FROM p), b AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY seq) AS block FROM s),
        q AS (SELECT {keys}, block, string_agg(CASE WHEN g IS NOT NULL THEN '> ' || replace(t, chr(10), chr(10) || '> ') ELSE t END, chr(10) || '>' || chr(10) ORDER BY seq) AS t FROM b GROUP BY {keys}, block),
        rendered AS (SELECT {keys}, trim(string_agg(t, chr(10) || chr(10) ORDER BY block)) || chr(10) AS markdown FROM q GROUP BY {keys})"""


_TOKEN = rf"{_L}+(?:-{_L}+)*"
_ABBREVIATIONS = ", ".join(f"'{w}'" for w in ("stb", "ill", "max", "min", "pl", "kb", "vö", "ún", "db", "uo", "ld", "ford", "jav"))
_ITEMS = f"""raw_items AS (SELECT r.book, r.page, r.id * 100000 + i.par_no AS seq, CASE r.kind WHEN 'title' THEN 'heading' WHEN 'caption' THEN 'caption' WHEN 'table' THEN 'table' ELSE 'para' END AS type, i.text,
        CASE WHEN r.kind = 'sidebar' THEN r.id END AS grp, false AS standalone FROM {REGIONS} r JOIN (SELECT region_id, par_no, text FROM ({_PARAGRAPHS}) UNION ALL SELECT region_id, 0, text FROM ({_SINGLE})
        UNION ALL SELECT region_id, 0, string_agg(text, chr(10) ORDER BY line_no, line_id) FROM {LINES} JOIN (SELECT region_id FROM {REGIONS} WHERE kind = 'table') USING (region_id) WHERE text IS NOT NULL GROUP BY 1) i USING (region_id)),
    page_texts AS (SELECT book, page, text FROM ({_continued("raw_items", "book, page")}) WHERE text <> '' UNION ALL SELECT book, page, text FROM raw_items WHERE type IN ('table', 'caption') AND text <> '')"""


def _tokens(texts: str) -> str:
    """tokens (keys of `texts`, token, parts): the words that are checked."""
    return rf"""raw AS (SELECT * EXCLUDE (text), unnest(regexp_extract_all(text, '[\p{{Nd}}%°]-{_TOKEN}|{_TOKEN}')) AS token FROM {texts}),
    cut AS (SELECT *, string_split(token, '-') AS p FROM raw WHERE NOT regexp_matches(token, '^[\p{{Nd}}%°]')),
    checked AS (SELECT * FROM (SELECT * EXCLUDE (p), list_filter(CASE WHEN upper(p[1]) = p[1] AND lower(p[1]) <> p[1] AND length(p[1]) <= 4 THEN p[1:1] ELSE p END, lambda x: length(x) >= 3) AS parts FROM cut) WHERE len(parts) > 0)"""


def _by_prefix(words: str, listed: str, keys: str = "") -> str:
    """The words that a list knows: equal, or a listed word of four letters or more with up to six letters behind it."""
    same = "".join(f"w.{k} = l.{k} AND " for k in filter(None, [keys]))
    return f"""SELECT DISTINCT {"w." + keys + ", " if keys else ""}w.word FROM (SELECT DISTINCT * FROM {words}) w JOIN (SELECT DISTINCT {keys + ", " if keys else ""}lower(word) AS listed FROM {listed}) l
        ON {same}(lower(w.word) = listed OR (length(listed) >= 4 AND starts_with(lower(w.word), listed) AND length(w.word) - length(listed) <= 6))"""


_TERM_WORDS = f"(SELECT unnest(regexp_extract_all(term, '{_TOKEN}')) AS word FROM terms)"
_QUALITY = f"""{_ITEMS}, {_tokens("page_texts")},
    known AS (SELECT DISTINCT lower(word) AS word FROM lexicon UNION SELECT unnest([{_ABBREVIATIONS}])),
    strange AS (SELECT DISTINCT token, word FROM (SELECT token, lower(unnest(parts)) AS word FROM checked) WHERE word NOT IN (SELECT word FROM known)),
    bad AS (SELECT DISTINCT token FROM strange WHERE word NOT IN ({_by_prefix("(SELECT word FROM strange)", _TERM_WORDS)})),
    words AS (SELECT book, page, count(*) AS words, count(*) FILTER (WHERE token IN (SELECT token FROM bad)) AS unknown FROM checked GROUP BY book, page),
    counted AS (SELECT book, page, count(*) AS lines, count(*) FILTER (WHERE conf >= 0 AND conf < 0.85) AS low_conf_lines FROM {LINES} GROUP BY book, page),
    quality AS (SELECT c.*, coalesce(w.words, 0) AS words, coalesce(w.unknown, 0) AS unknown, round(CASE WHEN coalesce(w.words, 0) = 0 THEN 0.0 ELSE w.unknown / w.words END, 4) AS unknown_ratio FROM counted c LEFT JOIN words w USING (book, page)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY unknown_ratio DESC, low_conf_lines DESC, page)::INT AS rank FROM quality),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY pages DESC, first_page, word)::INT AS rank FROM (SELECT book, token AS word, count(DISTINCT page) AS pages, min(page) AS first_page FROM checked
        WHERE token IN (SELECT token FROM bad) GROUP BY book, token)) WHERE rank <= 80)"""

_SKELETON = "translate({0}, 'áéíóöőúüűÁÉÍÓÖŐÚÜŰ', 'aeiooouuuAEIOOOUUU')"

SQL = {
    "latest_lines": f"SELECT line_id, book, page, line_no, text, conf FROM {LINES}",
    "latest_regions": f"SELECT region_id, book, page, id, kind, score FROM {REGIONS}",
    "clean_lines": f"SELECT line_id, {_clean('text')} AS text FROM ocr_lines",
    "line_predicates": f"SELECT line_id, {ends('text')} AS ends_sentence, {bullet('text')} AS is_bullet, {item('text')} AS is_item FROM ocr_lines",
    "region_text": f"SELECT region_id, string_agg(text, chr(10) ORDER BY line_no, line_id) AS text FROM {LINES} WHERE text IS NOT NULL GROUP BY region_id",
    "geometry_ops": f"""SELECT region_id, {_W} AS width, {_H} AS height, {_W} * {_H} AS area, (b.x0 + b.x1) / 2 AS cx, (b.y0 + b.y1) / 2 AS cy, {_COMMON} AS common, round({_OVERLAP}, 6) AS overlap,
        least(b.x0, c.x0) AS ux0, greatest(b.y1, c.y1) AS uy1, round_even(b.x0, 0)::INT AS ix0, ((b.x0 + b.x1) / 2 BETWEEN c.x0 AND c.x1) AND ((b.y0 + b.y1) / 2 BETWEEN c.y0 AND c.y1) AS inside
        FROM (SELECT r.region_id, r.box AS b, p.content AS c FROM {REGIONS} r JOIN page_layouts p USING (book, page))""",
    "content_box_parity": """WITH p AS (SELECT l.book, l.page, l.width, l.height, b.page_number_offset, CASE WHEN l.page % 2 = 1 THEN b.first_page_side WHEN b.first_page_side = 'right' THEN 'left' ELSE 'right' END AS s
        FROM page_layouts l JOIN books b USING (book))
        SELECT book, page, s AS side_by_page, page + page_number_offset AS printed, round(width * CASE WHEN s = 'right' THEN 0.04::DOUBLE ELSE 0.05::DOUBLE END, 3) AS x0, round(height * 0.05::DOUBLE, 3) AS y0,
        round(width * (1 - CASE WHEN s = 'right' THEN 0.05::DOUBLE ELSE 0.04::DOUBLE END), 3) AS x1, round(height * (1 - 0.05::DOUBLE), 3) AS y1 FROM p""",
    "filter_marking": f"""WITH m AS (SELECT region_id, b, c, CASE WHEN kind IN ('header', 'footer', 'page_number', 'ornament', 'figure') THEN 'kind:' || kind
        WHEN b.x0 <= width * 0.01::DOUBLE OR b.y0 <= height * 0.01::DOUBLE OR b.x1 >= width - width * 0.01::DOUBLE OR b.y1 >= height - height * 0.01::DOUBLE THEN 'edge'
        WHEN {_OVERLAP} < 0.5 THEN 'margin' WHEN {_W} * {_H} < width * height * 0.0004::DOUBLE THEN 'tiny' END AS dropped
        FROM (SELECT r.region_id, r.kind, r.box AS b, p.content AS c, p.width, p.height FROM {REGIONS} r JOIN page_layouts p USING (book, page)))
        SELECT region_id, dropped, CASE WHEN dropped IS NULL THEN greatest(b.x0, c.x0) ELSE b.x0 END AS x0, CASE WHEN dropped IS NULL THEN least(b.y1, c.y1) ELSE b.y1 END AS y1 FROM m""",
    "dedupe_container": f"""WITH {_NESTED} SELECT a.book, a.page, a.id, count(*) AS parts FROM nested a JOIN nested p ON a.book = p.book AND a.page = p.page AND a.kind = p.kind AND a.id <> p.id
        WHERE (p.x1 - p.x0) * (p.y1 - p.y0) > 0 AND greatest(0, p.x1 - p.x0) * greatest(0, p.y1 - p.y0) > 0
        AND greatest(0, least(a.x1, p.x1) - greatest(a.x0, p.x0)) * greatest(0, least(a.y1, p.y1) - greatest(a.y0, p.y0)) / ((p.x1 - p.x0) * (p.y1 - p.y0)) >= 0.7
        GROUP BY 1, 2, 3 HAVING count(*) >= 2""",
    "margin_notes": f"""WITH k AS (SELECT r.book, r.page, r.id, r.kind, {{'x0': CASE WHEN id % 5 = 4 THEN 1390 WHEN id % 2 = 0 THEN 110 ELSE 790 END, 'x1': CASE WHEN id % 5 = 4 THEN 1570 WHEN id % 2 = 0 THEN 670 ELSE 1350 END, 'y0': r.box.y0}} AS b,
        greatest(0.0, p.content.x1 - p.content.x0) AS cw FROM {REGIONS} r JOIN page_layouts p USING (book, page)),
        m AS (SELECT book, page, min(b.x0) AS l, max(b.x1) AS r FROM k WHERE kind IN ('text', 'title', 'sidebar', 'caption', 'table') AND {_W} > 0.3::DOUBLE * cw GROUP BY book, page),
        n AS (SELECT k.*, l, r FROM k JOIN m USING (book, page) WHERE kind IN ('text', 'sidebar') AND {_W} <= 0.3::DOUBLE * cw),
        s AS (SELECT book, page, id, b.y0 AS y0, 'left' AS side FROM n WHERE b.x1 <= l + cw * 0.02::DOUBLE UNION ALL SELECT book, page, id, b.y0, 'right' FROM n WHERE b.x0 >= r - cw * 0.02::DOUBLE)
        SELECT book, page, id, side, row_number() OVER (PARTITION BY book, page, side ORDER BY y0, id) - 1 AS ord FROM s""",
    "label_kinds": f"""WITH m(label, kind) AS (VALUES ('paragraph_title', 'title'), ('doc_title', 'title'), ('table', 'table'), ('image', 'figure'), ('chart', 'figure'), ('seal', 'figure'), ('header_image', 'ornament'), ('footer_image', 'ornament'),
        ('figure_title', 'caption'), ('table_title', 'caption'), ('chart_title', 'caption'), ('vision_footnote', 'caption'), ('header', 'header'), ('footer', 'footer'), ('number', 'page_number'))
        SELECT label, coalesce(kind, 'text') AS kind, count(*) AS n FROM (SELECT string_split(source, ':')[-1] AS label FROM {REGIONS}) LEFT JOIN m USING (label) GROUP BY 1, 2""",
    "line_pairing": f"""WITH l AS (SELECT region_id, line_no, text, box AS b FROM {LINES}),
        p AS (SELECT a.region_id, a.line_no, string_agg(o.text, ' ' ORDER BY o.b.x0, o.text) AS partner_text, count(*) AS n FROM l a JOIN l o USING (region_id)
        WHERE a.b IS NOT NULL AND o.b IS NOT NULL AND least(a.b.y1, o.b.y1 + 1) - greatest(a.b.y0, o.b.y0 + 1) >= 0.5 * least(a.b.y1 - a.b.y0, o.b.y1 - o.b.y0) GROUP BY 1, 2)
        SELECT l.region_id, l.line_no, coalesce(partner_text, '') AS partner_text, coalesce(n, 0)::INT AS n FROM l LEFT JOIN p USING (region_id, line_no)""",
    "word_filter": f"WITH {_WORDS} SELECT line_id, word_no::INT AS word_no, word, conf FROM kept",
    "edge_junk": f"""WITH {_WORDS}, m AS (SELECT *, NOT (length(word) <= 2 AND conf < 70 AND word NOT IN ({_AT_ENDS}) AND NOT regexp_matches(word, '^\\p{{Nd}}+$')) AS good FROM kept),
        z AS (SELECT *, min(CASE WHEN good THEN word_no END) OVER (PARTITION BY line_id) AS a, max(CASE WHEN good THEN word_no END) OVER (PARTITION BY line_id) AS b FROM m)
        SELECT line_id, word_no::INT AS word_no, word FROM z WHERE word_no BETWEEN a AND b""",
    "junk_lines": f"""WITH w AS (SELECT line_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS ws FROM {LINES})
        SELECT line_id, len(ws) >= 3 AND len(list_filter(ws, lambda x: length(trim(x, '.,;:!?"''()[]')) <= 2 AND lower(trim(x, '.,;:!?"''()[]')) NOT IN ({_SHORT}))) >= 0.6 * len(ws) AS junk FROM w""",
    "paragraph_breaks_par": _breaks("false"),
    "paragraph_breaks_geo": _breaks("boxes = n"),
    "hanging_indent": _breaks("boxes = n", hanging=True),
    "continuation_islands": f"""WITH k AS (SELECT *, lag(type) OVER o AS pt, lag(text) OVER o AS px FROM items WHERE type IN ('para', 'heading') WINDOW o AS (PARTITION BY book, grp ORDER BY seq)),
        m AS (SELECT *, CASE WHEN type = 'para' AND pt = 'para' AND NOT coalesce(standalone, false) AND px <> '' AND text <> '' AND NOT {bullet("text")} AND NOT {ends("px")} THEN NULL ELSE seq END AS start FROM k)
        SELECT item_id, max(start) OVER (PARTITION BY book, grp ORDER BY seq) AS island FROM m""",
    "heading_levels": """WITH h AS (SELECT book, seq, height, round_even(height, 0)::INT AS h FROM items WHERE type = 'heading' AND grp IS NULL), d AS (SELECT DISTINCT book, h FROM h WHERE height > 0),
        n AS (SELECT *, CASE WHEN h / lag(h) OVER (PARTITION BY book ORDER BY h) > 1.2 THEN 1 ELSE 0 END AS fresh FROM d), c AS (SELECT *, sum(fresh) OVER (PARTITION BY book ORDER BY h) AS c FROM n),
        m AS (SELECT *, max(c) OVER (PARTITION BY book) AS most FROM c)
        SELECT h.book, h.seq, (CASE WHEN h.height > 0 AND m.most BETWEEN 1 AND 2 THEN m.most - m.c + 1 ELSE 2 END)::INT AS level FROM h LEFT JOIN m USING (book, h)""",
    "render_markdown": f"WITH {_rendered('items', 'book')} SELECT book, markdown FROM rendered",
    "page_markdown": f"WITH {_merged('book, page')}, {_rendered('whole', 'book, page')} SELECT book, page, markdown FROM rendered",
    "book_markdown": f"WITH {_merged('book')}, {_rendered('whole', 'book')} SELECT book, '# ' || coalesce(title, book) || chr(10) || chr(10) || markdown AS markdown FROM rendered LEFT JOIN books USING (book)",
    "quality_rank": f"WITH {_QUALITY} SELECT book, page, lines, low_conf_lines, words, unknown, unknown_ratio, rank FROM ranked",
    "unknown_topk": f"WITH {_QUALITY} SELECT book, word, pages, rank FROM top",
    "quality_report": f"""WITH {_QUALITY} SELECT book, '# ' || coalesce(title, book) || chr(10) || chr(10) || '| page | lines | low confidence | unknown words |' || chr(10) || '| ---: | ---: | ---: | ---: |' || chr(10) || pages
        || coalesce(chr(10) || chr(10) || 'Unknown words: ' || w || chr(10), chr(10)) AS report
        FROM (SELECT book, string_agg('| ' || page || ' | ' || lines || ' | ' || low_conf_lines || ' | ' || CASE WHEN words > 0 THEN (round(unknown_ratio * 10000)::INT + 5) // 10 // 10 || '.' || (round(unknown_ratio * 10000)::INT + 5) // 10 % 10 || '%' ELSE '–' END || ' |', chr(10) ORDER BY rank) AS pages FROM ranked GROUP BY book)
        LEFT JOIN (SELECT book, string_agg(word || ' (' || pages || ')', ', ' ORDER BY rank) AS w FROM top GROUP BY book) USING (book) LEFT JOIN books USING (book)""",
    "page_items": f"WITH {_ITEMS} SELECT book, page, text FROM page_texts",
    "paragraphs_text": _PARAGRAPHS,
    "single_lines": _SINGLE,
    "merge_continuations": f"""SELECT item_id, text FROM (SELECT i.item_id, CASE WHEN m.n > 1 THEN m.text ELSE m.own END AS text FROM ({_continued("items", "book")}) m JOIN items i USING (book, seq))
        UNION ALL SELECT item_id, text FROM items WHERE type NOT IN ('para', 'heading') OR type IS NULL""",
    "listed_word_prefixes": f"""WITH {_tokens("(SELECT text FROM items WHERE type = 'para')")} {_by_prefix("(SELECT token AS word FROM checked)", _TERM_WORDS)}""",
    "book_word_prefixes": f"""WITH {_tokens("(SELECT book, text FROM items WHERE type = 'para')")} {_by_prefix("(SELECT book, token AS word FROM checked)", f"(SELECT book, unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM items WHERE type = 'heading')", "book")}""",
    "recogniser_rows": f"""SELECT region_id, (row_number() OVER (PARTITION BY region_id ORDER BY (box.y0 + box.y1) / 2, line_no) - 1)::INT AS line_no, left(text, length(text) // 2) || ' ' || substr(text, length(text) // 2 + 1) AS text, round(conf, 3) AS conf,
        round(box.x0, 3) AS x0, round(box.y1, 3) AS y1 FROM {LINES} WHERE box IS NOT NULL AND line_no IS NOT NULL AND length(text) > 1 AND conf >= 0.5""",
    "config_resolve": """SELECT book, page, CASE WHEN page IN (4, 6) THEN 1 ELSE 2 END AS columns, CASE WHEN page >= 3 THEN 0.1 ELSE 0.05 END::DOUBLE AS top, 0.06::DOUBLE AS inner_margin, 0.05::DOUBLE AS outer_margin, 300 AS dpi, 'doclayout' AS layout_engine FROM page_layouts""",
    "column_gutters": f"""WITH k AS (SELECT r.book, r.page, r.id, CASE WHEN id % 5 = 4 THEN 1390 WHEN id % 2 = 0 THEN 110 ELSE 790 END::DOUBLE AS x0, CASE WHEN id % 5 = 4 THEN 1570 WHEN id % 2 = 0 THEN 670 ELSE 1350 END::DOUBLE AS x1,
        p.content.x0 AS c0, p.content.x1 AS c1, greatest(0.0, p.content.x1 - p.content.x0) AS cw FROM {REGIONS} r JOIN page_layouts p USING (book, page)),
        spans AS (SELECT book, page, c0, cw, greatest(0, floor((greatest(x0, c0) - c0) / cw * 400))::INT AS a, least(399, trunc((least(x1, c1) - c0) / cw * 400))::INT AS z FROM k WHERE cw > 0 AND x1 - x0 < 0.6 * cw),
        cover AS (SELECT book, page, c0, cw, b, count(*) FILTER (WHERE b BETWEEN a AND z) > floor(count(*) / 10) AS busy FROM spans, (SELECT unnest(range(0, 400)) AS b) GROUP BY book, page, c0, cw, b),
        edges AS (SELECT *, min(CASE WHEN busy THEN b END) OVER p AS first_busy, max(CASE WHEN busy THEN b END) OVER p AS last_busy, sum(busy::INT) OVER (p ORDER BY b) AS island FROM cover WINDOW p AS (PARTITION BY book, page)),
        runs AS (SELECT book, page, c0, cw, first_busy, last_busy, island, min(b) AS i, max(b) + 1 AS j FROM edges WHERE NOT busy AND b BETWEEN 40 AND 359 GROUP BY ALL)
        SELECT book, page, (row_number() OVER (PARTITION BY book, page ORDER BY i) - 1)::INT AS k, round(c0 + (i + j) / 2 / 400 * cw, 3) AS x FROM runs WHERE j - i >= 2 AND first_busy < i AND last_busy >= j""",
    "vowel_fix": f"""WITH lex AS (SELECT DISTINCT word FROM lexicon WHERE lang = 'hun'), bare AS (SELECT DISTINCT {_SKELETON.format("word")} AS word FROM lex), u AS (SELECT word FROM bare WHERE length(word) >= 3 AND word NOT IN (SELECT word FROM lex)),
        p AS (SELECT u.word, l.word AS fixed, len(list_filter(range(1, length(u.word) + 1), lambda k: substr(u.word, k, 1) <> substr(l.word, k, 1))) AS d FROM u JOIN lex l ON {_SKELETON.format("l.word")} = {_SKELETON.format("u.word")}),
        n AS (SELECT *, min(d) OVER (PARTITION BY word) AS least FROM p WHERE d <= 2)
        SELECT word, min(fixed) AS fixed FROM n WHERE d = least GROUP BY word HAVING count(*) = 1""",
    "replacements": r"SELECT item_id, regexp_replace(regexp_replace(regexp_replace(text, '(?m)^([0-9]+) db ', '\1 darab ', 'g'), ' – ', ' -- ', 'g'), '(?m)\.\.\.$', '…', 'g') AS text FROM items WHERE type = 'para'",
    "page_select": "SELECT book, page::INT AS page FROM (SELECT book, unnest(range(1, n_pages + 1)) AS page FROM books) WHERE (page BETWEEN 2 AND 40 OR page >= 100) AND page NOT IN (5, 7, 9, 10, 11)",
    "stage_keys": f"SELECT region_id, substr(sha1('ocr' || chr(31) || string_agg(text, chr(10) ORDER BY line_no, line_id)), 1, 16) AS key FROM {LINES} WHERE text IS NOT NULL GROUP BY region_id",
    "stale_pages": f"SELECT DISTINCT book, page FROM {LINES} WHERE page % 2 <> 0",
    "set_ops": """SELECT source, 'both' AS side FROM (SELECT publisher AS source FROM books INTERSECT SELECT source FROM mix_targets) UNION ALL
        SELECT source, 'books' FROM (SELECT publisher AS source FROM books EXCEPT SELECT source FROM mix_targets) UNION ALL SELECT source, 'targets' FROM (SELECT source FROM mix_targets EXCEPT SELECT publisher FROM books)""",
    "box_statistics": f"""SELECT region_id, median(greatest(0.0, b.y1 - b.y0)) AS median_height, list_sort(list(greatest(0.0, b.y1 - b.y0)))[1 + count(*) // 2] AS upper_median, list_sort(list(b.x0))[1 + count(*) // 10] AS left_edge,
        round(quantile_cont(greatest(0.0, b.y1 - b.y0), 0.9), 4) AS p90, max(b.x1) AS right FROM (SELECT region_id, box AS b FROM {LINES} WHERE box IS NOT NULL) GROUP BY region_id""",
    "answer_lines": r"""WITH r AS (SELECT item_id, string_split(replace(text, '. ', '.' || chr(10) || chr(10)), chr(10)) AS parts FROM items WHERE type = 'para'),
        l AS (SELECT item_id, k, trim(parts[k]) AS text FROM r, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS k)),
        m AS (SELECT *, CASE WHEN text = '' AND coalesce(lag(text) OVER (PARTITION BY item_id ORDER BY k), '') <> '' THEN 1 ELSE 0 END AS fresh FROM l), c AS (SELECT *, sum(fresh) OVER (PARTITION BY item_id ORDER BY k)::INT AS par FROM m)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY k) - 1)::INT AS line_no, par, text FROM c WHERE text <> ''""",
}
