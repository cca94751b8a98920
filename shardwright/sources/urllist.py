"""Lists of URLs as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import UrlListFormatError
from ..functions.names import path_order
from ..functions.status import strip
from ..operators.schema import SLICING_URLS


def url_column(header: str) -> int | None:
    """Place of the URL column in a header with tabs; None without tabs; a header that names none is refused."""
    fields = [f.strip() for f in header.split("\t")]
    if len(fields) == 1:
        return None
    found = next((n for n in SLICING_URLS if n in fields), None)
    if found is None:
        raise UrlListFormatError(f"the header {fields} names no URL column; one of {list(SLICING_URLS)} is needed")
    return fields.index(found)


def looks_like_header(line: str) -> bool:
    return any(f.strip() in SLICING_URLS for f in line.split("\t"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line) of a text file, or of a folder's files in the order of their paths, whatever splits Spark reads them in.

    A first pass counts the lines of each split; sums over the splits before give its first line's place, and a second
    pass adds each line's place within its split. Only the counts, a row for each split, meet in one task.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    placed = read.select("value", *split, F.monotonically_increasing_id().alias("nth"))  # in order within a split
    counts = placed.groupBy("file", "block").agg(F.count("*").alias("lines"), F.min("nth").alias("first"))
    before = Window.orderBy(path_order(F.col("file")), "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", "first", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("start"))
    both = placed.join(starts, ["file", "block"])
    return both.select((F.col("start") + F.col("nth") - F.col("first")).cast("long").alias("pos"), F.rtrim("value", F.lit("\r")).alias("line"))


def read_urls(spark: SparkSession, path: str, has_header: bool | None = None) -> DataFrame:
    """(pos, url) of a list, one URL a line or a column of a file with tabs; empty values and short rows are left out.

    The first line decides; positions are those of the lines in the file.
    """
    lines = numbered_lines(spark, path)
    first = lines.where("pos = 0").collect()
    if not first:
        return spark.createDataFrame([], "pos long, url string")
    head = first[0]["line"]
    header = looks_like_header(head) if has_header is None else has_header
    if not header and "\t" in head:
        raise UrlListFormatError("columns but no header: nothing says which of them holds the URLs")
    column = url_column(head) if header else None
    value = F.col("line") if column is None else F.try_element_at(F.split("line", "\t"), F.lit(column + 1))
    out = lines.where(F.col("pos") >= int(header)).select("pos", strip(value).alias("url"))
    return out.where("url <> ''")
