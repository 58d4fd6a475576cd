"""Recognition engines behind one small interface, with stand-ins for tests and for clusters without models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

RESULT = "region_id long, engine string, markdown string, line_no int, text string, par int, conf double, error string"


class Engine(Protocol):
    """Reads the crop of a region: rows (text, par, conf), or Markdown for a table."""

    name: str

    def read(self, region: dict) -> tuple[str | None, list[tuple[str, int, float]]]: ...


class LineEngine:
    """Stand-in: a line per 40 units of the region's height."""

    name = "lines"

    def read(self, region: dict) -> tuple[str | None, list[tuple[str, int, float]]]:
        b = region["box"]
        n = max(1, int((b["y1"] - b["y0"]) // 40))
        return None, [(f"{region['kind']} {region['region_id']} line {k}", 0, 0.9) for k in range(n)]


class MarkdownEngine:
    """Stand-in: a table of one cell."""

    name = "markdown"

    def read(self, region: dict) -> tuple[str | None, list[tuple[str, int, float]]]:
        return f"| {region['region_id']} |\n| --- |", []


_ENGINES: dict[str, Callable[[], Engine]] = {"lines": LineEngine, "markdown": MarkdownEngine}
_LOADED: dict[str, Engine] = {}


def register(name: str, make: Callable[[], Engine]) -> None:
    """Make an engine known by name; it is loaded once per Python worker, when first asked for."""
    _ENGINES[name] = make


def get_engine(name: str) -> Engine:
    if name not in _ENGINES:
        raise ValueError(f"unknown engine {name!r}; known: {', '.join(sorted(_ENGINES))}")
    if name not in _LOADED:
        _LOADED[name] = _ENGINES[name]()
    return _LOADED[name]


@dataclass(frozen=True)
class Choice:
    """The engine of each kind of region, else the default."""

    default: str
    by_kind: dict[str, str] = field(default_factory=dict)

    def of(self, kind: str) -> str:
        return self.by_kind.get(kind) or self.default


READ_KINDS = ("text", "title", "caption", "sidebar", "table")


def recognise(regions: DataFrame, choice: Choice, make: dict[str, Callable[[], Engine]] | None = None) -> DataFrame:
    """RESULT rows for `regions` (region_id, kind, box) of the kinds that are read. An engine that fails gives one
    row with its error, and the work goes on; regions without a box or of no area are passed over."""
    engines = dict(make or {})

    def batches(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, maker in engines.items():
            register(name, maker)
        for batch in source:
            out = []
            for region in batch.to_dict("records"):
                name = choice.of(region["kind"])
                try:
                    markdown, lines = get_engine(name).read(region)
                    rows = [(text, par, conf) for text, par, conf in lines] or [(None, None, None)]
                    out += [(region["region_id"], name, markdown, k, text, par, conf, None) for k, (text, par, conf) in enumerate(rows)]
                except Exception as error:  # one bad crop must not end the job
                    out.append((region["region_id"], name, None, None, None, None, None, f"{type(error).__name__}: {error}"))
            columns = [c.split()[0] for c in RESULT.split(", ")]
            yield pd.DataFrame(out, columns=columns).astype({"line_no": "Int32", "par": "Int32", "conf": "Float64"})

    kept = regions.where(f"kind in {READ_KINDS} and box.x1 > box.x0 and box.y1 > box.y0").select("region_id", "kind", "box")
    return kept.mapInPandas(batches, RESULT)
