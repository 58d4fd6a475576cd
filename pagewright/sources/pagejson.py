"""Pages as JSON documents, to and from: the form in which layouts and results are exchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
LINE = f"struct<line_id:bigint,line_no:int,text:string,box:{BOX},par:int,conf:double>"
REGION = f"struct<id:int,kind:string,box:{BOX},score:double,source:string,grp:int,ord:int,dropped:string,lines:array<{LINE}>>"
PAGE = f"struct<book:string,page:int,side:string,width:int,height:int,content:{BOX},frames:array<{BOX}>,regions:array<{REGION}>>"


def page_documents(layouts: DataFrame, regions: DataFrame, lines: DataFrame) -> DataFrame:
    """(book, page, document): one JSON document per page with its regions, in order of id, and their lines."""
    of_region = lines.groupBy("region_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line_id", "text", "box", "par", "conf"))).alias("_l"))
    line = F.transform("_l", lambda x: F.struct(x["line_id"].alias("line_id"), x["line_no"].alias("line_no"), x["text"].alias("text"), x["box"].alias("box"), x["par"].alias("par"), x["conf"].alias("conf")))
    full = regions.join(of_region, "region_id", "left").withColumn("lines", F.coalesce(line, F.array().cast(f"array<{LINE}>")))
    of_page = full.groupBy("book", "page").agg(F.sort_array(F.collect_list(F.struct("id", "kind", "box", "score", "source", "grp", "ord", "dropped", "lines"))).alias("regions"))
    whole = layouts.join(of_page, ["book", "page"], "left").withColumn("regions", F.coalesce("regions", F.array().cast(f"array<{REGION}>")))
    return whole.select("book", "page", F.to_json(F.struct("book", "page", "side", "width", "height", "content", "frames", "regions")).alias("document"))


def parsed_pages(documents: DataFrame) -> DataFrame:
    """The pages of JSON documents (column `document`), with nested regions and lines; a broken one gives nulls."""
    return documents.select(F.from_json("document", PAGE).alias("p")).select("p.*")


def write_pages(documents: DataFrame, path: str) -> None:
    """Documents as JSON lines, a folder per book."""
    documents.select("book", F.col("document").alias("value")).write.mode("overwrite").partitionBy("book").text(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return parsed_pages(spark.read.text(path).select(F.col("value").alias("document")))


def write_markdown(books: DataFrame, path: str) -> None:
    """(book, markdown) as a text file per book."""
    books.select("book", F.col("markdown").alias("value")).repartition("book").write.mode("overwrite").partitionBy("book").text(path)
