"""Page images as arrays: contrast, skew, ruled frames, text blocks. One page is one call; pages are rows."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Box = tuple[float, float, float, float]
IMAGE = "height int, width int, data binary"


LEVELS = np.arange(256.0)


def counted(gray: np.ndarray) -> np.ndarray:
    """How often each grey level occurs; white, which most of a page is, by what is left over."""
    n = np.bincount(gray[gray < 255], minlength=256)
    n[255] = gray.size - n.sum()
    return n


def percentile(counts: np.ndarray, share: float) -> float:
    """As np.percentile has it, from the counts of the grey levels."""
    below = counts.cumsum()
    if not below[-1]:
        raise ValueError("an image without pixels")
    at = (below[-1] - 1) * (share / 100)
    k = int(at)
    low, high = (int(v) for v in np.searchsorted(below, (k, min(k + 1, below[-1] - 1)), "right"))
    part = at - k
    return high - (high - low) * (1 - part) if part >= 0.5 else low + (high - low) * part


def relevelled(gray: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Each grey level as another one."""
    table = np.clip(levels, 0, 255).astype(np.uint8).tobytes()
    return np.frombuffer(bytearray(gray.tobytes()).translate(table), np.uint8).reshape(gray.shape)


def stretched(gray: np.ndarray) -> np.ndarray:
    """Contrast from the first percentile (black) to the ninetieth (white); flat images stay as they are."""
    counts = counted(gray)
    low, high = percentile(counts, 1), percentile(counts, 90)
    if high - low < 30:
        return gray
    return relevelled(gray, (LEVELS - low) * (255.0 / (high - low)))


def box_mean(gray: np.ndarray, radius: int) -> np.ndarray:
    """Mean over squares, from running sums, which may run over: the sum of a square does not."""
    size = 2 * radius + 1
    sums = np.pad(np.pad(gray, radius, mode="edge").cumsum(0, dtype=np.uint32), ((1, 0), (0, 0)))
    sums = np.pad((sums[size:] - sums[:-size]).cumsum(1, dtype=np.uint32), ((0, 0), (1, 0)))
    return (sums[:, size:] - sums[:, :-size]) / size**2


def flattened(gray: np.ndarray, radius: int = 24) -> np.ndarray:
    """Uneven lighting evened: the image over its blurred background."""
    middle = np.uint8(percentile(counted(gray), 50))
    if gray.max() <= middle:  # paper of one level, and so is what is blurred
        return relevelled(gray, LEVELS / max(float(middle), 1.0) * 255.0)
    background = np.maximum(box_mean(np.maximum(gray, middle), radius), 1)
    return np.clip(gray / background * 255.0, 0, 255).astype(np.uint8)


def otsu(gray: np.ndarray) -> int:
    """The threshold that parts the histogram best."""
    n = counted(gray).astype(np.float64)
    below = n.cumsum()
    mass = (n * np.arange(256)).cumsum()
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.nan_to_num(apart).argmax())


def ink(gray: np.ndarray) -> np.ndarray:
    """True where there is ink."""
    return gray <= otsu(gray) if gray.size and gray.min() < gray.max() else np.zeros(gray.shape, bool)


def ink_ratio(marks: np.ndarray, b: Box) -> float:
    x0, y0, x1, y1 = (max(0, round(v)) for v in b)
    crop = marks[y0:y1, x0:x1]
    return float(crop.mean()) if crop.size else 0.0


def clearness(sums: np.ndarray, reach: int, angles: np.ndarray) -> np.ndarray:
    """How much the ink of the rows varies when they are moved as small turns would move them. sums: for each column and behind
    the last, the ink that each row has before it, the outermost rows repeated `reach` times. Columns that move alike are taken
    together."""
    width, height = sums.shape[0] - 1, sums.shape[1] - 2 * reach
    tangents = np.array([math.tan(math.radians(a)) for a in angles])
    shift = np.round((np.arange(width) - width / 2) * tangents[:, None]).clip(-reach, reach).astype(int)
    angle, first = np.nonzero(np.diff(shift, axis=1, prepend=reach + 1))
    starts = np.flatnonzero(first == 0)
    end = np.append(first[1:], width)
    end[starts[1:] - 1] = width
    moved = np.lib.stride_tricks.sliding_window_view(sums, height, 1)
    at = reach + shift[angle, first]
    return np.add.reduceat(moved[end, at] - moved[first, at], starts, 0).astype(np.float64).var(1)


def skew(marks: np.ndarray, most: float = 3.0) -> float:
    """The angle at which the text rows stand out best, first in quarters of a degree and then in twentieths."""
    height, width = marks.shape
    if not marks.size:
        return 0.0
    # no row moves further than this, nor beyond the image
    reach = min(height, int(width * math.tan(math.radians(most + 1))) + 2) if most < 45 else height
    sums = np.zeros((width + 1, height + 2 * reach), np.int32)
    sums[1:, reach : reach + height] = marks.cumsum(1, dtype=np.int32).T
    sums[:, :reach], sums[:, reach + height :] = sums[:, [reach]], sums[:, [reach + height - 1]]

    def best(angles: np.ndarray) -> float:
        parts = np.array_split(angles, min(len(angles), 1 + marks.size // 1_000_000))  # few angles at a time on large pages
        clear = np.concatenate([clearness(sums, reach, part) for part in parts])
        return float(max(zip(clear, -abs(angles), angles), key=lambda x: x[:2])[2])

    coarse = best(np.arange(-most, most + 0.01, 0.25))
    return round(best(np.arange(coarse - 0.25, coarse + 0.251, 0.05)), 2)


def rotated(gray: np.ndarray, degrees: float) -> np.ndarray:
    """Turned about its middle, white outside; nothing happens under a twentieth of a degree."""
    if abs(degrees) < 0.05:
        return gray
    h, w = gray.shape
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    x, y = np.arange(w) - w / 2, (np.arange(h) - h / 2)[:, None]
    out = np.full(gray.shape, 255, np.uint8)
    # where all four neighbours are white, so is the result: only the others are weighed, on rows that can meet one
    shown = gray != 255
    below = np.append(0, shown.any(1).cumsum())
    shown[:, :-1] |= shown[:, 1:]
    shown[:-1] |= shown[1:]
    ends = s * x[[0, -1]] + c * y + h / 2 if w else np.zeros((h, 1))
    rows = np.flatnonzero(below[(ends.max(1) + 3).clip(0, h).astype(int)] > below[(ends.min(1) - 2).clip(0, h).astype(int)])
    fx, fy = c * x - s * y[rows] + w / 2, s * x + c * y[rows] + h / 2
    at = fy.astype(np.intp) * w + fx.astype(np.intp)
    mixed = np.flatnonzero(shown.ravel().take(at, mode="clip") & (fx >= 0) & (fy >= 0) & (fx < w - 1) & (fy < h - 1))
    k, u, v = at.ravel()[mixed], fx.ravel()[mixed] % 1, fy.ravel()[mixed] % 1
    p, q, r, t = (gray.ravel()[k + d] for d in (0, 1, w, w + 1))
    turned = (p * (1 - u) * (1 - v) + q * u * (1 - v) + r * (1 - u) * v + t * u * v).round().astype(np.uint8)
    out[rows[mixed // w], mixed % w] = turned
    return out


def prepared(gray: np.ndarray, most_skew: float = 3.0) -> tuple[np.ndarray, float]:
    """Evened, stretched and straightened, and the angle it was turned by."""
    even = stretched(flattened(gray))
    angle = skew(ink(even), most_skew)
    return rotated(even, angle), angle


def runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each run of ink, row by row."""
    h, w = marks.shape
    wide = np.zeros((h, w + 2), np.int8)
    wide[:, 1:-1] = marks
    edges = np.flatnonzero(wide.ravel()[1:] != wide.ravel()[:-1])
    row, start = np.divmod(edges[::2], w + 2)
    return row, start, edges[1::2] - row * (w + 2)


def united(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The last member of the group that each of n has when the pairs i, j are united."""
    last = np.arange(n)
    while len(i):
        np.maximum.at(last, i, last[j])
        np.maximum.at(last, j, last[i])
        while (last[last] != last).any():
            last = last[last]
        i, j = last[i], last[j]
        apart = i != j
        i, j = i[apart], j[apart]
    return last


def component_boxes(marks: np.ndarray) -> np.ndarray:
    """A row x0, y0, x1, y1 for each connected part, corners touching included, in the order of their last runs: runs that
    touch on neighbouring rows are united."""
    row, start, end = runs(marks)
    n, step = len(row), marks.shape[1] + 2
    # runs of the row above that end at this one's start or later, and start at its end or earlier
    above = (row - 1) * step
    low = np.searchsorted(row * step + end, above + start, "left")
    count = np.searchsorted(row * step + start, above + end, "right") - low
    below = np.repeat(np.arange(n), count)
    last = united(n, below, np.arange(len(below)) + np.repeat(low - count.cumsum() + count, count))
    order = np.argsort(last, kind="stable")
    if not n:
        return np.zeros((0, 4), int)
    first = np.flatnonzero(np.diff(last[order], prepend=-1))
    at = order[first]
    return np.stack([np.minimum.reduceat(start[order], first), row[at], np.maximum.reduceat(end[order], first), row[last[at]] + 1], 1)


def components(marks: np.ndarray) -> list[Box]:
    """Boxes around the connected parts, corners touching included."""
    return [tuple(b) for b in component_boxes(marks).astype(float).tolist()]


def run_filter(marks: np.ndarray, length: int, along: int) -> np.ndarray:
    """Only runs of ink of at least `length` along an axis."""
    lines = marks if along == 1 else marks.T
    row, start, end = runs(lines)
    long = end - start >= length
    if not long.any():
        return np.zeros_like(marks)
    edges = np.zeros((lines.shape[0], lines.shape[1] + 1), np.int8)
    edges[row[long], start[long]], edges[row[long], end[long]] = 1, -1
    out = edges.cumsum(1, dtype=np.int8)[:, :-1] > 0
    return out if along == 1 else out.T


def line_mask(marks: np.ndarray) -> np.ndarray:
    """Ruled lines: long horizontal or vertical runs."""
    h, w = marks.shape
    return run_filter(marks, max(3, int(0.12 * w)), 1) | run_filter(marks, max(3, int(0.06 * h)), 0)


def window_sums(marks: np.ndarray, size: int, turned: bool = False) -> np.ndarray:
    """How much ink there is in the square of that size about each place, for even sizes one place further up and left, or
    down and right if `turned`; outside of the image there is none."""
    before, after = (size - 1 - size // 2, size // 2) if turned else (size // 2, size - 1 - size // 2)
    sums = np.pad(np.pad(marks.astype(np.int32), ((before, after), (before, after))).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return sums[size:, size:] - sums[:-size, size:] - sums[size:, :-size] + sums[:-size, :-size]


def windows(marks: np.ndarray, size: int, axis: int, unite: np.ufunc) -> np.ndarray:
    """All (np.logical_and) or any (np.logical_or) of so many neighbours along an axis, from each on that has as many, by doubling."""
    out, span = (marks if axis == 0 else marks.T), 1
    while span < size:
        step = min(span, size - span)
        out = unite(out[:-step], out[step:])
        span += step
    return out if axis == 0 else out.T


def opened(marks: np.ndarray, size: int) -> np.ndarray:
    """Only ink in which a square of that size fits."""
    if min(marks.shape) < size:
        return np.zeros(marks.shape, bool)
    fits = windows(windows(marks, size, 0, np.logical_and), size, 1, np.logical_and)
    if not fits.any():
        return np.zeros(marks.shape, bool)
    return windows(windows(np.pad(fits, size - 1), size, 0, np.logical_or), size, 1, np.logical_or)


def closed(marks: np.ndarray, size: int) -> np.ndarray:
    """Ink with the gaps filled in which no square of that size fits."""
    if not marks.any() and min(marks.shape) >= size:
        return marks
    return ~opened(~marks, size)


def inside_frames(boxes: list[Box], content: Box, slack: float, em: float) -> list[Box]:
    """Boxes that can be frames: large enough, under half of the content, and not at its edges, as borders are."""
    w, h = content[2] - content[0], content[3] - content[1]
    least_w, least_h = int(0.2 * w), int(max(3 * em, 0.04 * h))
    out = []
    for b in boxes:
        bw, bh = b[2] - b[0], b[3] - b[1]
        inside = b[0] > content[0] + slack and b[1] > content[1] + slack and b[2] < content[2] - slack and b[3] < content[3] - slack
        if inside and bw >= least_w and bh >= least_h and bw * bh < 0.5 * w * h:
            out.append(b)
    return out


def ruled_frames(marks: np.ndarray, content: Box, em: float = 20.0) -> list[Box]:
    """Boxes drawn with lines, inside the content and under half of it."""
    return inside_frames(components(closed(line_mask(marks), 9)), content, 0.005 * max(marks.shape), em)


def tinted_panels(gray: np.ndarray, content: Box, em: float = 20.0, delta: float = 22.0) -> list[Box]:
    """Boxes on a tinted ground, inside the content and under half of it: darker than the paper by `delta`, lighter than ink,
    without the gaps that letters make."""
    x0, y0, x1, y1 = (int(round(v)) for v in content)
    part = gray[y0:y1, x0:x1]
    if not part.size:
        return []
    size = max(3, int(1.5 * em))
    tint = (part < percentile(counted(part), 90) - delta) & (part > 90)
    found = components(closed(opened(tint, size), 2 * size))
    return inside_frames([(b[0] + x0, b[1] + y0, b[2] + x0, b[3] + y0) for b in found], content, 0.005 * max(gray.shape), em)


def letter_height(parts: list[Box]) -> float:
    """Median height of parts that can be letters, 20 without any."""
    hs = [b[3] - b[1] for b in parts if 5 <= b[3] - b[1] <= 300 and b[2] - b[0] <= 5 * (b[3] - b[1])]
    return float(np.median(hs)) if hs else 20.0


def word_gap(parts: list[Box], em: float) -> float:
    """Ninetieth percentile of the gaps from a letter to the next on its row; half an em without any."""
    at = np.array(parts, float).reshape(-1, 4)
    at = at[at[:, 3] - at[:, 1] > 0.3 * em]
    at = at[np.argsort(at[:, 0], kind="stable")]
    after = np.searchsorted(at[:, 0], at[:, 2])
    gaps = []
    for k in range(0, len(at), 4096):
        b, near = at[k : k + 4096, None], after[k : k + 4096, None] + np.arange(40)
        o = at[near.clip(max=len(at) - 1)]
        level = (near < len(at)) & (np.minimum(b[..., 3], o[..., 3]) - np.maximum(b[..., 1], o[..., 1]) > 0)
        found = np.flatnonzero(level.any(1))
        gap = o[found, level[found].argmax(1), 0] - b[found, 0, 2]
        gaps.append(gap[gap < 3 * em])
    gaps = np.concatenate(gaps) if gaps else np.zeros(0)
    return float(np.percentile(gaps, 90)) if len(gaps) else 0.5 * em


def smeared(marks: np.ndarray, across: int, down: int) -> np.ndarray:
    """Ink spread by so many pixels to the right and downwards, centred."""
    out = marks
    for axis, reach in ((1, across), (0, down)):
        least, most = min(0, 1 - reach // 2), reach - reach // 2
        round_about = np.arange(-most, out.shape[axis] - least) % out.shape[axis]
        out = windows(out.take(round_about, axis), most - least + 1, axis, np.logical_or)
    return out


def same_rows(at: np.ndarray) -> np.ndarray:
    """Which of the boxes share more than half of the lower one's height."""
    shared = np.minimum(at[:, None, 3], at[None, :, 3]) - np.maximum(at[:, None, 1], at[None, :, 1])
    height = at[:, 3] - at[:, 1]
    return shared > 0.5 * np.minimum(height[:, None], height[None, :])


def joined_neighbours(boxes: list[Box]) -> list[Box]:
    """Fragments of a row as one where the gap between them is a word's for their own height, the leftmost first, until
    none is left; a union can close a gap that was too wide before."""
    at = np.array(sorted(boxes), float).reshape(-1, 4)
    while True:
        gap, height = at[None, :, 0] - at[:, None, 2], at[:, 3] - at[:, 1]
        close = same_rows(at) & (gap >= 0) & (gap < 0.8 * np.minimum(height[:, None], height[None, :]))
        first = np.flatnonzero(close)
        if not len(first):
            return [tuple(map(float, b)) for b in at]
        i, j = divmod(int(first[0]), len(at))
        at[i] = [*np.minimum(at[i, :2], at[j, :2]), *np.maximum(at[i, 2:], at[j, 2:])]
        at = np.delete(at, j, 0)
        at = at[np.argsort(at[:, 0], kind="stable")]


def in_columns(boxes: list[Box]) -> np.ndarray:
    """Which fragments have another one beside them on their row. Only neighbours in the order of their tops are looked
    at, as far down as a fragment reaches."""
    at = np.array(boxes, float).reshape(-1, 4)
    order = np.argsort(at[:, 1], kind="stable")
    tops, flags = at[order, 1], np.zeros(len(at), bool)
    reach = np.searchsorted(tops, at[order, 3], "right")
    height = at[:, 3] - at[:, 1]
    for k, i in enumerate(order):
        below = order[k + 1 : reach[k]]
        shared = np.minimum(at[i, 3], at[below, 3]) - np.maximum(at[i, 1], at[below, 1])
        beside = (shared > 0.5 * np.minimum(height[i], height[below])) & ((at[below, 0] > at[i, 2]) | (at[i, 0] > at[below, 2]))
        flags[below[beside]] = True
        flags[i] |= beside.any()
    return flags


def stacked(boxes: list[Box], columnar: np.ndarray, em: float) -> list[list[int]]:
    """Fragments stacked into blocks from the top: each goes on the block that it is closest below, if gap, height and edges
    agree and both stand in columns or neither does; a fragment alone on its row may also end a block in columns."""
    out: list[list[int]] = []
    at, line, single = np.zeros((0, 4)), np.zeros(0), np.zeros(0, bool)  # of each block: its box, line height, not in columns
    for i in sorted(range(len(boxes)), key=lambda i: (boxes[i][1], boxes[i][0])):
        x0, y0, x1, y1 = boxes[i]
        high, low = np.maximum(line, y1 - y0), np.minimum(line, y1 - y0)
        gap = y0 - at[:, 3]
        near = (gap <= 1.1 * high) & (gap >= -0.5 * high) & (high <= 1.4 * np.maximum(1.0, low))
        edges = np.minimum(x1, at[:, 2]) - np.maximum(x0, at[:, 0]) >= 0.5 * np.minimum(x1 - x0, at[:, 2] - at[:, 0])
        within = (x0 >= at[:, 0] - 1.5 * em) & (x1 <= at[:, 2] + 1.5 * em)
        alike = (single == (not columnar[i])) | (within & (not columnar[i]))
        fits = np.flatnonzero(near & edges & alike)
        if len(fits):
            k = fits[np.argmin(gap[fits])]
            out[k].append(i)
            at[k] = [min(at[k, 0], x0), min(at[k, 1], y0), max(at[k, 2], x1), max(at[k, 3], y1)]
            line[k] = np.median([boxes[m][3] - boxes[m][1] for m in out[k]])
        else:
            out.append([i])
            at, line, single = np.vstack([at, boxes[i]]), np.append(line, y1 - y0), np.append(single, not columnar[i])
    return out


def block_kind(marks: np.ndarray, b: Box, fragments: int, em: float, title_ratio: float = 1.45, big_ink: float = 0.5) -> str:
    """figure, where most ink is in parts larger than letters; title, where the letters are, in few fragments; else text."""
    x0, y0, x1, y1 = (int(round(v)) for v in b)
    part = marks[y0:y1, x0:x1]
    found = component_boxes(part)
    if not len(found):
        return "text"
    wide, high = found[:, 2] - found[:, 0], found[:, 3] - found[:, 1]
    huge = (high > 3.5 * em) | (wide > 12 * em)
    if huge.any():
        sums = np.pad(part.cumsum(0, dtype=np.int32).cumsum(1, dtype=np.int32), ((1, 0), (1, 0)))
        x0, y0, x1, y1 = found.T
        inked = sums[y1, x1] - sums[y0, x1] - sums[y1, x0] + sums[y0, x0]
        if inked[huge].sum() > big_ink * inked.sum() and (b[3] - b[1] > 6 * em or part.mean() > 0.35):
            return "figure"
    letters = high[high >= 4]
    return "title" if len(letters) and np.median(letters) > title_ratio * em and fragments <= 3 else "text"


def blocks(marks: np.ndarray) -> tuple[list[tuple[str, Box]], float]:
    """Kinds and boxes of a page's blocks, from the top, and the letter height: lines are smeared into fragments, specks
    left out, neighbours joined, and fragments stacked."""
    parts = components(marks)
    em = letter_height(parts)
    reach = int(min(max(1.5 * word_gap(parts, em), 0.8 * em), 2.5 * em)) + 1
    large = [(b[0] + reach // 2, b[1], b[2] - reach // 2, b[3]) for b in components(smeared(marks, reach, 0)) if not (b[3] - b[1] < 0.35 * em and b[2] - b[0] < 2 * em)]
    fragments = joined_neighbours(large)
    out = []
    for stack in stacked(fragments, in_columns(fragments), em):
        at = np.array([fragments[i] for i in stack])
        b = (*map(float, at[:, :2].min(0)), *map(float, at[:, 2:].max(0)))
        out.append((block_kind(marks, b, len(stack), em), b))
    return sorted(out, key=lambda kb: (kb[1][1], kb[1][0])), em


def crop(gray: np.ndarray, b: Box, others: list[Box], pad_x: float = 0.012, pad_y: int = 6) -> np.ndarray:
    """A region's image with some slack, in which other regions are painted white."""
    h, w = gray.shape
    dx = int(round(pad_x * w))
    x0, y0, x1, y1 = max(0, round(b[0]) - dx), max(0, round(b[1]) - pad_y), min(w, round(b[2]) + dx), min(h, round(b[3]) + pad_y)
    out = gray[y0:y1, x0:x1].copy()
    for o in others:
        apart = min(b[2], o[2]) <= max(b[0], o[0]) or min(b[3], o[3]) <= max(b[1], o[1])
        if apart:
            out[max(0, round(o[1]) - y0) : max(0, round(o[3]) - y0), max(0, round(o[0]) - x0) : max(0, round(o[2]) - x0)] = 255
    return out


def png(gray: np.ndarray) -> bytes:
    """A grey PNG file."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")

    h, w = gray.shape
    rows = b"".join(b"\0" + gray[y].tobytes() for y in range(h))
    head = w.to_bytes(4, "big") + h.to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """The grey image of a PNG file without interlacing, eight bits deep; colours are averaged."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG file")
    at, packed, head = 8, b"", b""
    while at < len(data):
        size, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + size]
        head, packed = (body if kind == b"IHDR" else head), packed + (body if kind == b"IDAT" else b"")
        at += size + 12
    w, h = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(head[9])
    if head[8] != 8 or channels is None or head[12]:
        raise ValueError("only grey or colour PNG files of eight bits without interlacing")
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    for y in range(h):
        kind, row = raw[y, 0], raw[y, 1:].astype(np.int32)
        up = out[y - 1].astype(np.int32) if y else np.zeros(w * channels, np.int32)
        if kind == 2:
            row = row + up
        elif kind in (1, 3, 4):
            for x in range(w * channels):
                left = int(out[y, x - channels]) if x >= channels else 0
                corner = int(up[x - channels]) if x >= channels else 0
                guess = left if kind == 1 else (left + up[x]) // 2 if kind == 3 else min((left, int(up[x]), corner), key=lambda v: (abs(left + up[x] - corner - v), (v != left) + (v == corner)))
                out[y, x] = (row[x] + guess) & 255
            continue
        out[y] = row & 255
    grey = out.reshape(h, w, channels)[..., : max(1, channels - (channels in (2, 4)))]
    return grey.mean(2).round().astype(np.uint8)


# Colours of an overlay, red, green and blue.
COLOURS = {"text": (0, 90, 200), "title": (200, 0, 0), "table": (0, 140, 0), "figure": (150, 0, 150), "sidebar": (220, 130, 0), "caption": (0, 150, 150)}


def overlay(gray: np.ndarray, regions: list[tuple[str, Box, str | None]]) -> np.ndarray:
    """The page in colour with a frame round each region (kind, box, reason it was dropped); dropped ones are grey and
    crossed out."""
    out = np.repeat(gray[:, :, None], 3, 2)
    h, w = gray.shape
    for kind, b, dropped in regions:
        x0, y0, x1, y1 = (int(min(max(0, v), m - 1)) for v, m in zip(map(round, b), (w, h, w, h)))
        colour = (150, 150, 150) if dropped else COLOURS.get(kind, (90, 90, 90))
        out[y0, x0 : x1 + 1] = out[y1, x0 : x1 + 1] = colour
        out[y0 : y1 + 1, x0] = out[y0 : y1 + 1, x1] = colour
        if dropped:
            n = max(x1 - x0, y1 - y0) + 1
            out[np.linspace(y0, y1, n).round().astype(int), np.linspace(x0, x1, n).round().astype(int)] = colour
    return out


ANALYSIS = "book string, page int, skew double, ink double, letter_height double, frames int, blocks int, error string"
# Pages that are sent on at a time: thousands of images in one batch would not fit a worker's memory.
AT_ONCE = 16


def layout_boxes(layouts: DataFrame, regions: DataFrame) -> DataFrame:
    """(book, page, width, height, frames, skew_deg, boxes): what is to be drawn on each page."""
    boxes = regions.where("dropped is null").groupBy("book", "page").agg(F.sort_array(F.collect_list("box")).alias("boxes"))
    both = layouts.select("book", "page", "width", "height", "frames", "skew_deg").join(boxes, ["book", "page"], "left")
    parts = int(layouts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a page is a heavy row: spread them, however few bytes they are; by columns the join's own parts would be kept, and those
    # are put together while they are small
    return both.repartition(parts)


def drawn_page(row, scale: float) -> np.ndarray:
    """A row of layout_boxes as an image."""
    image = np.full((int(row.height * scale), int(row.width * scale)), 255, np.uint8)
    h, w = image.shape
    for b in row.boxes if row.boxes is not None else []:
        x0, y0, x1, y1 = (int(b[c] * scale) for c in ("x0", "y0", "x1", "y1"))
        x = np.arange(x0, min(x1, w))
        letters = x[((x - x0) % 5 < 3) & ((x - x0) % 40 < 33)]  # of three columns, with gaps, and wider ones between words
        for y in range(y0, max(y0 + 1, min(y1, h) - 6), 11):
            image[y : y + 6, letters] = 40
    for b in row.frames if row.frames is not None else []:
        x0, y0, x1, y1 = (int(b[c] * scale) for c in ("x0", "y0", "x1", "y1"))
        image[y0, x0:x1] = image[min(y1, h) - 1, x0:x1] = 0
        image[y0:y1, x0] = image[y0:y1, min(x1, w) - 1] = 0
    return rotated(image, row.skew_deg if row.skew_deg == row.skew_deg and row.skew_deg is not None else 0.0)


def drawn(layouts: DataFrame, regions: DataFrame, scale: float = 0.2) -> DataFrame:
    """(book, page, height, width, data): pages with rows of letters in their regions and lines for frames, turned by
    their skew_deg, at a share of their size."""

    def batches(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            for k in range(0, len(batch), AT_ONCE):
                made = [(row.book, row.page, drawn_page(row, scale)) for row in batch[k : k + AT_ONCE].itertuples()]
                yield pd.DataFrame([(b, p, *image.shape, image.tobytes()) for b, p, image in made], columns=["book", "page", "height", "width", "data"])

    return layout_boxes(layouts, regions).mapInPandas(batches, f"book string, page int, {IMAGE}")


def analysed_page(gray: np.ndarray, most_skew: float) -> tuple:
    """What ANALYSIS has of one page behind its name."""
    image, angle = prepared(gray, most_skew)
    marks = ink(image)
    kinds, em = blocks(marks)
    whole = (0.0, 0.0, float(gray.shape[1]), float(gray.shape[0]))
    return angle, round(float(marks.mean()), 4), em, len(ruled_frames(marks, whole, em)) + len(tinted_panels(image, whole, em)), len(kinds), None


def _analysed(pages: DataFrame, image_of: Callable[..., np.ndarray], most_skew: float) -> DataFrame:
    def batches(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            out = []
            for row in batch.itertuples():
                try:
                    out.append((row.book, row.page, *analysed_page(image_of(row), most_skew)))
                except Exception as error:  # a bad scan must not end the job
                    out.append((row.book, row.page, None, None, None, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ANALYSIS.split(", ")])

    return pages.mapInPandas(batches, ANALYSIS)


def analysed(images: DataFrame, most_skew: float = 3.0) -> DataFrame:
    """(book, page, skew, ink, letter_height, frames, blocks, error): what the pixel steps find on each page, once it is evened,
    stretched and straightened. A page that cannot be read has its error and nothing else."""
    return _analysed(images, lambda row: np.frombuffer(row.data, np.uint8).reshape(row.height, row.width), most_skew)


def drawn_and_analysed(layouts: DataFrame, regions: DataFrame, scale: float = 0.2, most_skew: float = 3.0) -> DataFrame:
    """analysed(drawn(layouts, regions)), but each image stays in the worker that drew it. A page that cannot be drawn has its
    error, too."""
    return _analysed(layout_boxes(layouts, regions), lambda row: drawn_page(row, scale), most_skew)
