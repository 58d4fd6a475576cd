from __future__ import annotations

import pytest

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
LINES = f"line_id long, book string, page int, region_id long, line_no int, engine string, text string, box {BOX}, par int, conf double, read_at timestamp"
REGIONS = f"region_id long, book string, page int, id int, kind string, box {BOX}, score double"
ITEMS = "item_id long, book string, page int, seq int, type string, text string, standalone boolean"
BOOKS = "book string, lang string, page_number_offset int, title string"


class Tables:
    """Small tables of the driver's form; `extra` adds a column with a name that operators use themselves."""

    def __init__(self, spark):
        self.spark = spark

    def lines(self, rows):
        """rows: (line_id, book, page, region_id, line_no, text)"""
        return self.spark.createDataFrame([(i, b, p, r, n, "e", t, None, 0, 0.9, None) for i, b, p, r, n, t in rows], LINES)

    def regions(self, rows):
        """rows: (region_id, book, page, id, kind)"""
        return self.spark.createDataFrame([(*r, None, 0.9) for r in rows], REGIONS)

    def items(self, rows):
        """rows: (item_id, book, page, text, standalone)"""
        return self.spark.createDataFrame([(i, b, p, i, "para", t, s) for i, b, p, t, s in rows], ITEMS)

    def books(self, rows):
        """rows: (book, lang, offset)"""
        return self.spark.createDataFrame([(b, lang, o, None) for b, lang, o in rows], BOOKS)


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark)
