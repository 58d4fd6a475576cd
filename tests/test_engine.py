from __future__ import annotations

import json
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pagewright.functions import lexicon as lx
from pagewright.operators import lines as ln
from pagewright.operators import pixels as px
from pagewright.sources import config, engines, images, pagejson
from pagewright.streaming import pages as stream

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
DATA = "/root/testdata/sf0.001"


def test_parse_pages():
    assert config.parse_pages(["1-3", 7, "9,11"]) == [1, 2, 3, 7, 9, 11]
    assert config.parse_pages("98-", 100) == [98, 99, 100]
    assert config.parse_pages(None) == []
    for wrong in ("5-3", "98-"):
        with pytest.raises(ValueError):
            config.parse_pages(wrong)


def test_settings(spark):
    settings = config.Settings({"columns": 2}, [("10-12", {"columns": 1, "margins": {"top": 0.2}})])
    assert settings.page(11)["columns"] == 1 and settings.page(9)["columns"] == 2
    assert settings.page(11)["margins"] == {"top": 0.2, "bottom": 0.05, "inner": 0.04, "outer": 0.05}
    with pytest.raises(ValueError):
        config.Settings({"colums": 2})
    assert config.with_value('title: ""  # name', "title", "Könyv") == 'title: "Könyv"  # name'
    pages = spark.createDataFrame([(p,) for p in (1, 9, 10, 11, 12, 13, 2000)], "page int")
    made = {r.page: json.loads(r.settings) for r in config.resolved(pages, settings).collect()}
    assert made == {p: settings.page(p) | {"side": "right" if p % 2 else "left"} for p in made} and len(made) == 7
    many = config.Settings({"side": "left"}, [(str(k), {"dpi": k}) for k in range(2, 60)])
    made = {r.page: json.loads(r.settings) for r in config.resolved(pages, many).collect()}
    assert made == {p: many.page(p) for p in made} and made[12]["dpi"] == 12 and made[1]["side"] == "left"


def test_settings_files(tmp_path, monkeypatch):
    books = tmp_path / "books"
    for name in ("b.yaml", "a/book.yaml", "b/book.yaml", "_hidden.yaml", "empty/other.txt"):
        (books / name).parent.mkdir(parents=True, exist_ok=True)
        (books / name).write_text("columns: 2\ntitle: x\npage_overrides: {'3-4': {dpi: 400}}\n", encoding="utf-8")
    (tmp_path / "defaults.yaml").write_text("dpi: 200\nmargins: {top: 0.1}\n", encoding="utf-8")
    assert config.list_books(tmp_path) == ["a", "b"] and config.config_path(tmp_path, "b") == books / "b.yaml" and config.config_path(tmp_path, "a") == books / "a" / "book.yaml"
    made = config.load_settings(books / "b.yaml", tmp_path / "defaults.yaml")
    assert made.page(3)["dpi"] == 400 and made.page(5)["dpi"] == 200 and made.page(5)["margins"]["top"] == 0.1 and made.page(5)["columns"] == 2
    assert config.load_settings(books / "b.yaml", tmp_path / "none.yaml").page(5)["dpi"] == 300
    monkeypatch.delenv(config.ROOT_VARIABLE, raising=False)
    assert config.find_root(books / "a") == tmp_path
    with pytest.raises(FileNotFoundError):
        config.find_root(Path("/proc"))
    monkeypatch.setenv(config.ROOT_VARIABLE, "/x")
    assert config.find_root(books) == Path("/x")


def test_recogniser_rows(spark):
    rows = [(1, 0, "jobb", 0.9, (300.0, 0.0, 500.0, 30.0)), (1, 1, "bal", 0.8123, (0.0, 2.0, 250.0, 31.0)), (1, 2, "lent", 0.7, (0.0, 40.0, 400.0, 70.0)), (1, 3, "kicsi", 0.9, (0.0, 80.0, 3.0, 99.0)), (1, 4, "rossz", 0.4, (0.0, 80.0, 30.0, 99.0)), (1, 5, " ", 0.9, (0.0, 80.0, 30.0, 99.0)), (1, 6, None, 0.9, None)]
    made = ln.recogniser_rows(spark.createDataFrame(rows, f"r int, ordinal int, text string, score double, box {BOX}"), ["r"]).orderBy("line_no").collect()
    assert [(x.line_no, x.text, x.conf) for x in made] == [(0, "bal jobb", 0.812), (1, "lent", 0.7)]


def test_vowels_mended(spark):
    texts = spark.createDataFrame([(1, "A szep, szep kor; Szep kár."), (2, ""), (3, None)], "i int, text string")
    lexicon = spark.createDataFrame([("szép",), ("kör",), ("kor",), ("kár",)], "word string")
    assert {r.i: r.text for r in lx.vowels_mended(texts, ["i"], lexicon).collect()} == {1: "A szép, szép kor; Szep kár.", 2: "", 3: None}


def test_tokens_and_repairs(spark):
    df = spark.createDataFrame([("10%-kal k10-zel VÉ-je a kard-fal szép!",), (None,), ("",)], "x string")
    assert df.select(lx.checked_tokens(F.col("x")).alias("t")).first().t == ["kard-fal", "szép"]
    lexicon = spark.createDataFrame([("szép",), ("kör",), ("kor",), ("asztal",), (None,)], "word string")
    words = spark.createDataFrame([("szep",), ("kór",), ("asztal",), ("ásztál",), (None,), ("xy",)], "word string")
    assert {tuple(r) for r in lx.vowel_repairs(words, lexicon).collect()} == {("szep", "szép"), ("ásztál", "asztal")}
    listed = spark.createDataFrame([("b", "mentalior"), ("b", "abc")], "book string, word string")
    tried = spark.createDataFrame([("b", w) for w in ("mentaliorban", "Mentalior", "mentaliorbanvalaki", "abc", "abcd")], "book string, word string")
    assert {r.word for r in lx.with_book_words(tried, listed).collect()} == {"mentaliorban", "Mentalior", "abc"}


def test_word_lines(spark):
    rows = [(1, 0, 0, 0, 0, "~", 20.0), (1, 1, 0, 0, 0, "szép", 90.0), (1, 2, 0, 0, 0, "30%", 13.0), (1, 3, 0, 0, 0, "q", 40.0), (1, 4, 0, 0, 1, "d", 50.0), (1, 5, 0, 0, 1, "Z", 50.0), (1, 6, 0, 0, 1, "H", 50.0), (1, 7, 1, 0, 0, "  ", 90.0), (1, 8, 1, 0, 0, "vége", -1.0)]
    df = spark.createDataFrame([(*r, (20.0, 20.0, 40.0, 40.0)) for r in rows], f"r int, word_no int, block int, par int, line int, word string, conf double, box {BOX}")
    made = ln.word_lines(df, ["r"]).collect()
    assert [(r.line_no, r.par, r.text, r.conf, r.box.x0) for r in made] == [(0, 0, "szép 30%", 0.477, 0.0)]


def test_latest_lines(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", None), (2, "c", None)], "line_id long, text string, t int").withColumn("read_at", F.timestamp_seconds("t"))
    assert sorted((r.line_id, r.text) for r in ln.latest_lines(df).collect()) == [(1, "b"), (2, "c")]


def test_engines_isolate_errors(spark):
    class Broken:
        name = "broken"

        def read(self, region):
            raise RuntimeError("no model")

    df = spark.createDataFrame([(1, "text", (0.0, 0.0, 10.0, 80.0)), (2, "table", (0.0, 0.0, 10.0, 80.0)), (3, "figure", (0.0, 0.0, 10.0, 80.0)), (4, "text", None)], f"region_id long, kind string, box {BOX}")
    made = engines.recognise(df, engines.Choice("lines", {"table": "broken"}), {"broken": Broken}).collect()
    assert {(r.region_id, r.error) for r in made} == {(1, None), (2, "RuntimeError: no model")}
    with pytest.raises(ValueError):
        engines.get_engine("none")


def test_page_documents_round_trip(spark, tmp_path):
    read = lambda n: spark.read.parquet(f"{DATA}/{n}.parquet")
    documents = pagejson.page_documents(read("page_layouts"), read("regions"), ln.latest_lines(read("ocr_lines")))
    pagejson.write_pages(documents, str(tmp_path / "pages"))
    back = pagejson.read_pages(spark, str(tmp_path / "pages"))
    assert back.count() == documents.count() and back.where("book is null").count() == 0
    assert back.selectExpr("sum(size(regions))").first()[0] == read("regions").count()


def test_stream_drops_repeated_lines(spark, tmp_path):
    lines = spark.read.parquet(f"{DATA}/ocr_lines.parquet")
    lines.repartition(3).write.parquet(str(tmp_path / "in"))
    got = []
    frame = stream.first_deliveries(stream.line_stream(spark, str(tmp_path / "in"), lines, 2), "4000 days")
    stream.run_to_end(frame, lambda batch, _: got.append(batch.select("line_id").toPandas()), str(tmp_path / "checkpoint"))
    seen = [i for f in got for i in f["line_id"]]
    assert len(seen) == len(set(seen)) == lines.select("line_id").distinct().count()


def test_stale(spark):
    now = stream.page_keys(spark.createDataFrame([("b", 1, 1, "x"), ("b", 2, 2, "y")], "book string, page int, line_id long, text string"))
    before = stream.page_keys(spark.createDataFrame([("b", 1, 1, "x"), ("b", 2, 2, "z")], "book string, page int, line_id long, text string"))
    assert [tuple(r) for r in stream.stale(now, before).collect()] == [("b", 2)]


def test_pixels():
    page = np.full((400, 300), 255, np.uint8)
    for y in range(60, 340, 20):
        page[y : y + 8, 40:260:3] = 0
    marks = px.ink(page)
    assert abs(px.skew(marks)) <= 0.3
    turned = px.rotated(page, 1.5)
    assert abs(abs(px.skew(px.ink(turned))) - 1.5) < 0.3
    assert (px.read_png(px.png(page)) == page).all()
    framed = np.full((400, 300), 255, np.uint8)
    framed[100, 60:200] = framed[200, 60:200] = framed[100:201, 60] = framed[100:201, 199] = 0
    assert px.ruled_frames(px.ink(framed), (0, 0, 300, 400)) == [(60.0, 100.0, 200.0, 201.0)]
    assert px.components(np.zeros((3, 3), bool)) == [] and len(px.components(np.eye(4, dtype=bool))) == 1
    shown = px.overlay(page, [("text", (10, 10, 50, 50), None), ("text", (60, 60, 90, 90), "edge")])
    assert shown.shape == (400, 300, 3) and tuple(shown[10, 20]) == px.COLOURS["text"] and tuple(shown[75, 75]) == (150, 150, 150)
    flat = np.full((10, 10), 200, np.uint8)
    assert (px.stretched(flat) == flat).all() and not px.ink(flat).any()


def test_panels_fragments_and_blocks():
    page = np.full((800, 600), 250, np.uint8)
    page[300:500, 100:350] = 200
    page[340:348, 120:330:3] = 20
    assert px.tinted_panels(page, (0, 0, 600, 800), 8.0) == [(100.0, 300.0, 350.0, 500.0)]
    assert px.tinted_panels(page, (0, 0, 600, 800), 80.0) == [] and px.tinted_panels(page, (5, 5, 5, 5)) == []
    marks = np.zeros((9, 9), bool)
    marks[2:7, 2:7] = True
    marks[0, 8] = True
    assert px.window_sums(marks, 3)[4, 4] == 9 and px.opened(marks, 3).sum() == 25 and px.closed(~marks, 3)[0, 8] == True  # noqa: E712
    row = [(0.0, 0.0, 10.0, 10.0), (16.0, 1.0, 30.0, 11.0), (60.0, 0.0, 80.0, 10.0), (0.0, 20.0, 30.0, 30.0)]
    joined = px.joined_neighbours(row)
    assert joined == [(0.0, 0.0, 30.0, 11.0), (0.0, 20.0, 30.0, 30.0), (60.0, 0.0, 80.0, 10.0)] and px.joined_neighbours([]) == []
    assert list(px.in_columns(joined)) == [True, False, True] and len(px.in_columns([])) == 0
    near = [(0.0, 18.0 * k, 200.0, 18.0 * k + 10) for k in range(4)] + [(0.0, 200.0, 200.0, 210.0), (300.0, 0.0, 500.0, 10.0), (300.0, 18.0, 500.0, 28.0)]
    assert px.stacked(near, px.in_columns(near), 10.0) == [[0, 1, 2, 3], [5, 6], [4]]
    text = np.zeros((300, 300), bool)
    for y in range(20, 120, 16):
        text[y : y + 9, 20:280] = np.tile(np.r_[np.ones(4, bool), np.zeros(2, bool)], 44)[:260]
    text[180:280, 40:200] = True
    kinds, em = px.blocks(text)
    assert em == 9.0 and [k for k, _ in kinds] == ["text", "figure"]


def test_images_in_files(spark, tmp_path):
    page = np.full((60, 40), 255, np.uint8)
    page[20:24, 5:35:2] = 0
    rows = [("b", 1, 60, 40, bytearray(page.tobytes())), ("b", 2, 60, 40, None)]
    images.write_images(spark.createDataFrame(rows, "book string, page int, height int, width int, data binary"), str(tmp_path))
    (tmp_path / "b" / "0003.png").write_bytes(b"no image")
    back = {r.page: r for r in images.read_images(spark, str(tmp_path)).collect()}
    assert bytes(back[1].data) == page.tobytes() and back[3].error.startswith("ValueError") and 2 not in back
    assert images.prepared_pages(images.read_images(spark, str(tmp_path))).count() == 1


def test_contract(spark):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 40
    assert contract.entry(spark).count() > 0


def test_core_runs_without_the_training_operators():
    for path in Path(contract.__file__).parent.joinpath("pagewright").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text(encoding="utf-8")), path
