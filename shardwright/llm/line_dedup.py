"""Line dedup: lines that many documents share stay in one of them. DataFrame functions only.

Lines are exploded, normalised (blanks stripped at both ends, A-Z lower-cased) and hashed to 128 bits; a key's distinct
documents are counted, and the keys of enough documents are kept with the largest id that holds each. Documents' lines
meet these keys again; a document's dropped positions come together, and its other lines are joined by position.

A key may hold a third of all rows. Distinct pairs (key, document) are spread by both before the documents are
counted; where lines meet their keys, each key of over a HEAVY-th of the lines found (so at most HEAVY keys, broadcast) is
replicated and its lines are dealt over the replicas. Texts are shuffled once, to meet their dropped positions.

Null or empty text: one empty line, which stays. A row with a null id is no document for the counts, but loses the keys
that are found in enough others. Rows that repeat an id are one document and each lose or keep the same keys. Other
columns are passed by, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, texts, written

BLANKS = " \t\n\x0b\f\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: Keys of more than this part of the shared lines are replicated, once for each such part.
HEAVY = 10_000


def lowered(text: Column) -> Column:
    """A-Z as a-z, nothing else; the faster function where all characters are of one byte."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def keyed_lines(docs: DataFrame, min_chars: int, *more: str) -> DataFrame:
    """(doc_id, *more, pos, h1, h2) of the lines whose keys are long enough."""
    lines = docs.select("doc_id", *more, F.posexplode(F.split(lowered(F.col("text")), "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", *more, "pos", F.btrim("line", F.lit(BLANKS)).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select("doc_id", *more, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def shared_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, n_lines, keeper) of the keys of at least min_docs documents."""
    counted = keyed_lines(docs, min_chars).groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n_docs"), F.count("*").alias("n_lines"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def dropped_positions(docs: DataFrame, shared: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(of_id, of_mark, gone): the positions that texts lose, of each different text of an id once."""
    total = shared.agg(F.sum("n_lines")).first()[0] or 0
    copies = F.ceil(F.col("n_lines") * HEAVY / F.lit(max(total, 1))).cast("int")
    heavy = shared.where(copies > 1).select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), copies.alias("copies"))
    lines = keyed_lines(docs, min_chars, "mark").join(F.broadcast(heavy), (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")), "left")
    dealt = F.coalesce(F.pmod(F.xxhash64("doc_id", "mark", "pos"), F.col("copies")).cast("int"), F.lit(0))
    keys = shared.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), "keeper", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)).alias("copy"))
    met = lines.withColumn("dealt", dealt).join(keys, (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2")) & (F.col("dealt") == F.col("copy")))
    lost = met.where(~F.col("keeper").eqNullSafe(F.col("doc_id")))
    return lost.groupBy(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark")).agg(F.collect_set("pos").alias("gone"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and text without the dropped lines, a row for each row of df."""
    docs = texts(df, id_col, text_col)
    shared = written(shared_keys(docs, min_chars, min_docs), "lines")
    marked = docs.withColumn("mark", F.struct(F.octet_length("text").alias("n"), F.xxhash64("text").alias("h")))
    gone = dropped_positions(marked, shared, min_chars)
    both = marked.withColumn("lines", F.split("text", "\n")).drop("text").join(gone, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")  # by a hash set, in order
    text = F.array_join(F.transform(stay, lambda p: F.get("lines", p)), "\n")
    return both.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(text).alias("text"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_SQL = """WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
 sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

QUERIES = {"op12_line_dedup": op12_line_dedup}
ORACLES = {"op12_line_dedup": _SQL}
