"""Pixel steps taken over whole arrays: the same as plain versions, and quick enough for many pages."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest

from pagewright.operators import pixels as px

WHOLE = (0.0, 0.0, 300.0, 430.0)


def drawn(turn: float = 0.0) -> np.ndarray:
    page = np.full((430, 300), 255, np.uint8)
    letters = np.flatnonzero((np.arange(220) % 5 < 3) & (np.arange(220) % 40 < 33)) + 40
    for y in range(40, 390, 11):
        page[y : y + 6, letters] = 40
    return px.rotated(page, turn)


def plain_skew(marks: np.ndarray, most: float = 3.0) -> float:
    def rated(angle: float) -> tuple[float, float]:
        shift = np.round((np.arange(marks.shape[1]) - marks.shape[1] / 2) * math.tan(math.radians(angle))).astype(int)
        at = (np.arange(marks.shape[0])[:, None] + shift[None, :]).clip(0, marks.shape[0] - 1)
        return float(marks[at, np.arange(marks.shape[1])[None, :]].sum(1).astype(np.float64).var()), -abs(angle)

    coarse = max(np.arange(-most, most + 0.01, 0.25), key=rated)
    return round(float(max(np.arange(coarse - 0.25, coarse + 0.251, 0.05), key=rated)), 2)


def plain_rotated(gray: np.ndarray, degrees: float) -> np.ndarray:
    h, w = gray.shape
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    out = np.full(gray.shape, 255, np.uint8)
    for y in range(h):
        for x in range(w):
            fx, fy = c * (x - w / 2) - s * (y - h / 2) + w / 2, s * (x - w / 2) + c * (y - h / 2) + h / 2
            a, b = math.floor(fx), math.floor(fy)
            if 0 <= a < w - 1 and 0 <= b < h - 1:
                (p, q), (r, t) = gray[b : b + 2, a : a + 2].astype(float)
                u, v = fx - a, fy - b
                out[y, x] = round(p * (1 - u) * (1 - v) + q * u * (1 - v) + r * (1 - u) * v + t * u * v)
    return out


def plain_boxes(marks: np.ndarray) -> set:
    left, out = {(int(y), int(x)) for y, x in np.argwhere(marks)}, set()
    while left:
        todo = part = [left.pop()]
        for y, x in todo:
            near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= near
            part += near
        ys, xs = zip(*part)
        out.add((float(min(xs)), float(min(ys)), max(xs) + 1.0, max(ys) + 1.0))
    return out


def test_a_page_takes_less_than_plain_skew_alone():
    def least(work) -> float:
        took = []
        for _ in range(3):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    page = drawn(1.5)
    marks = px.ink(page)

    def whole_page() -> None:
        image, _ = px.prepared(page)
        found = px.ink(image)
        _, em = px.blocks(found)
        px.ruled_frames(found, WHOLE, em), px.tinted_panels(image, WHOLE, em)

    assert px.skew(marks) == plain_skew(marks)
    assert least(whole_page) < least(lambda: plain_skew(marks))


@pytest.mark.parametrize("seed", range(12))
def test_plain_versions_agree(seed):
    rng = np.random.default_rng(seed)
    h, w = (int(v) for v in rng.integers(1, 40, 2))
    gray = rng.integers(0, 256, (h, w)).astype(np.uint8)
    gray[rng.random((h, w)) < (0.0, 0.5, 0.9, 1.0)[seed % 4]] = 255
    marks = rng.random((h, w)) < (0.1, 0.4, 0.7)[seed % 3]
    assert [px.percentile(px.counted(gray), q) for q in (1, 50, 90)] == list(np.percentile(gray, (1, 50, 90)))
    assert px.skew(marks) == plain_skew(marks)
    for degrees in (0.4, -1.5, 30.0):
        assert (px.rotated(gray, degrees) == plain_rotated(gray, degrees)).all()
    found = px.components(marks)
    assert set(found) == plain_boxes(marks)
    for size in (1, 2, 3, 8):
        plain = px.window_sums(px.window_sums(marks, size) == size * size, size, True) > 0
        assert (px.opened(marks, size) == plain).all()
        spread = marks.copy()
        for k in range(1, size + 1):
            spread |= np.roll(marks, k - size // 2, 1)
        assert (px.smeared(marks, size, 0) == spread).all()
    padded = np.pad(gray.astype(float), 3, mode="edge")
    assert (px.box_mean(gray, 3) == [[padded[y : y + 7, x : x + 7].sum() / 49 for x in range(w)] for y in range(h)]).all()


def test_images_stay_in_the_worker(spark):
    box, frame = (200.0, 200.0, 1200.0, 1500.0), (300.0, 1600.0, 900.0, 1900.0)
    kind = "struct<x0:double,y0:double,x1:double,y1:double>"
    pages = [("b", 1, 1500, 2100, [frame], 1.2), ("b", 2, 1500, 2100, [], None), ("b", 3, 1500, 2100, None, -0.7), ("b", 4, 2, 2, [], 0.0)]
    layouts = spark.createDataFrame(pages, f"book string, page int, width int, height int, frames array<{kind}>, skew_deg double")
    regions = spark.createDataFrame([("b", p, box, None) for p in (1, 2)] + [("b", 3, box, "edge")], f"book string, page int, box {kind}, dropped string")
    apart = sorted(map(tuple, px.analysed(px.drawn(layouts, regions)).collect()), key=lambda r: r[1])
    found = sorted(map(tuple, px.drawn_and_analysed(layouts, regions).collect()), key=lambda r: r[1])
    assert found == apart
    # one task would draw them all if small parts were put together
    assert px.drawn(layouts, regions).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert [r[1] for r in found] == [1, 2, 3, 4] and abs(abs(found[0][2]) - 1.2) < 0.1 and found[3][-1] == "ValueError: an image without pixels"
