"""Lines brought together by region, once, and read region by region in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import checkpointed

# The languages of the books; any other counts as 'und'.
LANGS = ("ara", "deu", "ell", "eng", "fra", "hin", "hun", "jpn", "tha", "zho")
# Languages whose words are not parted by spaces.
UNSPACED = ("jpn", "zho", "tha")
COLUMNS = ("region_id", "line_no", "line_id", "text", "out", "kind", "lang", "book", "page", "ord", "offset")


def book_facts(books: DataFrame) -> DataFrame:
    """(book, lang, offset), each book once; an unknown or null language is 'und'. Checkpointed, as it is joined often."""
    lang = F.when(F.col("lang").isin(*LANGS), F.col("lang")).otherwise("und")
    return checkpointed(books.where("book is not null").select("book", lang.alias("lang"), F.col("page_number_offset").alias("offset")).groupBy("book").agg(F.min("lang").alias("lang"), F.min("offset").alias("offset")))


def facts_of(books: DataFrame) -> DataFrame:
    """`books` themselves where they are book_facts, else their book_facts."""
    return books if books.columns == ["book", "lang", "offset"] else book_facts(books)


def region_lines(lines: DataFrame, regions: DataFrame, books: DataFrame, furniture: DataFrame | None = None, kind: str | None = None) -> DataFrame:
    """COLUMNS of all lines with what their region brings, partitioned and sorted by region and in it by line; `out` are the
    lines in `furniture` (line_id, region_id). With `kind` only those of regions of that kind; else lines of unknown
    regions are there too, those without a region as region -1.

    Text is partitioned once, before the join, which keeps it so; a region is a few lines, so no partition is skewed."""
    known = regions.where("region_id is not null").groupBy("region_id").agg(F.min("kind").alias("kind"), F.min("book").alias("book"), F.min("page").alias("page"), F.min("id").alias("ord"))
    if kind is not None:
        known = known.where(F.col("kind") == kind)
    known = known.join(facts_of(books), "book", "left").withColumn("lang", F.coalesce("lang", F.lit("und")))
    if furniture is not None:
        of_region = furniture.where("region_id is not null").groupBy("region_id").agg(F.collect_set("line_id").alias("_out"))  # no more than the lines of a region
        known = known.join(of_region, "region_id", "left")
        out = F.coalesce(F.array_contains("_out", F.col("line_id")), F.lit(False))
    else:
        out = F.lit(False)
    text = lines.where("line_id is not null and region_id is not null").select("region_id", "line_id", "line_no", "text").repartition("region_id")
    joined = text.join(known, "region_id", "left" if kind is None else "inner").withColumn("out", out)
    return joined.sortWithinPartitions("region_id", "line_no", "line_id").select(*COLUMNS)


@dataclass
class Block:
    """Whole regions: per line its text, id, region's number and whether it is left out; per region the rest."""

    texts: list[str]
    line_ids: np.ndarray
    region: np.ndarray
    out: np.ndarray
    starts: np.ndarray
    facts: dict[str, list]


def _block(table: pa.Table) -> Block:
    ids, line_ids = table.column("region_id").to_numpy(), table.column("line_id").to_numpy()
    fresh = np.concatenate([[True], ids[1:] != ids[:-1]])
    kept = np.flatnonzero(fresh | np.concatenate([[True], line_ids[1:] != line_ids[:-1]]))  # lines delivered twice, once
    fresh = fresh[kept]
    starts = np.flatnonzero(fresh)
    first = pa.array(kept[starts])
    facts = {c: table.column(c).take(first).to_pylist() for c in ("region_id", "kind", "lang", "book", "page", "ord", "offset")}
    texts = [t or "" for t in table.column("text").take(pa.array(kept)).to_numpy().tolist()]
    return Block(texts, line_ids[kept], np.cumsum(fresh) - 1, table.column("out").to_numpy()[kept], starts, facts)


def region_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The sorted rows of region_lines in blocks of whole regions."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        ids = batch.column("region_id").to_numpy()
        if held and held[-1].column("region_id")[-1].as_py() == ids[0]:
            same = int(np.searchsorted(ids != ids[0], True))
        else:
            same = 0
        if same == len(batch):
            held.append(batch)
            continue
        if held:
            yield _block(pa.Table.from_batches([*held, batch.slice(0, same)]).combine_chunks())
        last = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if (ids != ids[-1]).any() else same
        if last > same:
            yield _block(pa.Table.from_batches([batch.slice(same, last - same)]))
        held = [batch.slice(max(last, same))]
    if held:
        yield _block(pa.Table.from_batches(held).combine_chunks())
