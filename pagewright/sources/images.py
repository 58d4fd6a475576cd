"""Page images in files: PNG pages in and out, a row per page."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pixels import IMAGE, png, prepared, read_png

_PAGE = r"([^/]+)/([0-9]+)\.png$"


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """(book, page, height, width, data, error) of folder/<book>/<page>.png; a file that is no such image has its error."""

    def decoded(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                book, page = re.search(_PAGE, path).groups()
                try:
                    gray = read_png(bytes(content))
                    rows.append((book, int(page), *gray.shape, gray.tobytes(), None))
                except Exception as error:  # one broken scan must not end the job
                    rows.append((book, int(page), None, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["book", "page", "height", "width", "data", "error"]).astype({"height": "Int32", "width": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(folder)
    return files.where(F.col("path").rlike(_PAGE)).select("path", "content").mapInPandas(decoded, f"book string, page int, {IMAGE}, error string")


def write_images(images: DataFrame, folder: str) -> None:
    """Each page as folder/<book>/<page>.png; the folder is one that all executors share."""

    def write(rows) -> None:
        for row in rows:
            if row.data is not None:
                path = f"{folder}/{row.book}/{row.page:04d}.png"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as out:
                    out.write(png(np.frombuffer(row.data, np.uint8).reshape(row.height, row.width)))

    images.select("book", "page", "height", "width", "data").foreachPartition(write)


def prepared_pages(images: DataFrame, most_skew: float = 3.0) -> DataFrame:
    """(book, page, height, width, data, skew_deg): pages evened, stretched and straightened."""

    def made(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            rows = []
            for row in batch.itertuples():
                image, angle = prepared(np.frombuffer(row.data, np.uint8).reshape(int(row.height), int(row.width)), most_skew)
                rows.append((row.book, row.page, *image.shape, image.tobytes(), angle))
            yield pd.DataFrame(rows, columns=["book", "page", "height", "width", "data", "skew_deg"])

    return images.where("data is not null").mapInPandas(made, f"book string, page int, {IMAGE}, skew_deg double")
