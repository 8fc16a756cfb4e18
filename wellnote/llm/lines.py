"""Line deduplication: lines that many documents share stay in one of them.

Lines are exploded with their positions and compared by a key: the line without white space
(space, \\t to \\r) at its ends, A-Z in lower case.  Keys are hashed to 128 bits, documents are counted
per hash, and a key of at least ``min_chars`` code points found in at least ``min_docs`` documents
loses all its lines but those of the largest doc_id that holds it.  What is left is put together
again by position.

Only (document, position, hash) rows are dealt by hash, never texts.  Counting goes by (hash,
document) first, so a line of every document is spread over all tasks; the lines of a document meet
its text by one join, which Spark broadcasts where it knows the lists to be small.

* A null or empty text is one empty line; an empty table gives an empty table.
* Documents are doc_ids: rows that share one count once, as do all rows without one, which rank
  below every other.  Each row's lines are judged by themselves; repeated rows come out repeated.
* The lines of the largest doc_id all stay, also several with one key.
* Rows travel as structs, so columns of any name pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellnote.llm.common import ascii_lower, cut

MIN_CHARS = 20
MIN_DOCS = 3
#: The white space stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tid, pos, h1, h2) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tid"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "tid", "pos", line_key(F.col("line")).alias("key"))
    return keys.filter(F.length("key") >= min_chars).select(
        "doc_id", "tid", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


def shared_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, last) of the keys that at least ``min_docs`` documents hold."""
    return lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one")) \
        .groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("last")) \
        .filter(F.col("n_docs") >= min_docs)


def _judged(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(row, n_lines, n_dropped, kept) of every row."""
    lines = cut(keyed_lines(docs, min_chars))
    shared = cut(shared_keys(lines, min_docs))
    # Positions of one text: no more than it has lines.
    lost = lines.join(shared, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last"))) \
        .groupBy(F.col("doc_id").alias("lost_id"), F.col("tid").alias("lost_tid")) \
        .agg(F.collect_set("pos").alias("lost"))
    lost = cut(lost)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).withColumn("tid", F.xxhash64(text))
    met = rows.join(lost, F.col("row.doc_id").eqNullSafe(F.col("lost_id"))
                    & (F.col("tid") == F.col("lost_tid")), "left")
    split = lines_of(F.col("row.text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda at: F.get(split, at)), "\n"))
    return met.select("row", F.size(split).cast("long").alias("n_lines"),
                      F.coalesce(F.array_size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
                      kept.alias("kept"))


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lines that stay as ``text``; other columns and the number of rows as they were."""
    return _judged(docs, min_chars, min_docs).select(
        F.col("row").withField("text", F.col("kept")).alias("row")).select("row.*")


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256): lines before and how many went, digest of what stays."""
    return _judged(docs, min_chars, min_docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: The contract's result over documents.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT r, doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS line FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""
