"""Benchmark decontamination with a distributed positional inverted index.

Phrases of benchmark items (windows of 13 words) are looked up in an index of the corpus: one
posting (term, text, position) for each occurrence.  Every phrase starts from the postings of its
rarest term, shifted by the term's offset in the phrase; the lists of the next rarest terms are
intersected with it, and what is left is compared with the whole phrase on the text itself.

Only terms that some phrase needs are indexed: its ``ANCHORS`` rarest ones by their counts over the
whole corpus.  Built-in functions only; joins are dealt by term or text, and a side is broadcast
only where Spark finds it below its size threshold.

Texts are named by two hashes (``tid``, ``crc``), so null or repeated ids need no care and equal
texts are judged alike.  A null or empty text has no words and no hit; an item without words has no
window; an empty benchmark hits nothing; an empty corpus gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellnote.llm.common import ascii_lower, cut

WINDOW = 13
ANCHORS = 3
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_WORD), F.lit(0))


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tid"),
                       F.crc32(text.cast("binary")).alias("crc"))


def phrases_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, wid, phrase, length): every run of ``window`` words; a shorter item is one phrase."""
    listed = items.select("item_id", words().alias("w")).filter(F.size("w") > 0)
    runs = listed.select("item_id", "w", F.least(F.size("w"), F.lit(window)).alias("length")) \
        .select("item_id", "w", "length", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)).alias("at")) \
        .select("item_id", F.slice("w", F.col("at"), F.col("length")).alias("phrase"), "length")
    return runs.select("item_id", F.md5(F.concat_ws(" ", "phrase")).alias("wid"), "phrase", "length").distinct()


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id, tid, crc, n_words and the words of every text, stored: texts are split only once."""
    return cut(_named(docs).select("doc_id", "tid", "crc", words().alias("w"))
               .withColumn("n_words", F.size("w").cast("long")))


def term_counts(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, count) over all texts for the terms given; terms that never occur are left out."""
    return tokens.select(F.explode("w").alias("term")).join(terms, "term", "left_semi") \
        .groupBy("term").agg(F.count("*").alias("count"))


def positional_index(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, tid, crc, pos) for every occurrence of the terms; equal texts have one set of postings."""
    return tokens.select("tid", "crc", F.posexplode("w").alias("pos", "term")) \
        .join(terms, "term", "left_semi").select("term", "tid", "crc", "pos").distinct()


def anchors_of(phrases: DataFrame, counts: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """(wid, rank, off, term): the rarest terms of each phrase whose terms all occur in the corpus."""
    placed = phrases.select("wid", "length", F.posexplode("phrase").alias("off", "term")) \
        .join(counts, "term")
    rarest = W.partitionBy("wid").orderBy("count", "term", "off")
    return placed.withColumn("rank", F.row_number().over(rarest)) \
        .withColumn("known", F.count("*").over(W.partitionBy("wid"))) \
        .filter((F.col("known") == F.col("length")) & (F.col("rank") <= anchors)) \
        .select("wid", "rank", "off", "term")


def _anchored(tokens: DataFrame, phrases: DataFrame, anchors: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The phrases, their anchors and the index of the anchors' terms, each stored."""
    known = cut(phrases.select("wid", "phrase", "length").distinct())
    vocabulary = cut(known.select(F.explode("phrase").alias("term")).distinct())
    picked = cut(anchors_of(known, term_counts(tokens, vocabulary), anchors))
    terms = cut(picked.select("term").distinct())
    return known, picked, cut(positional_index(tokens, terms))


def _texts_of(tokens: DataFrame, asked: DataFrame) -> DataFrame:
    """Words of the texts that ``asked`` names, one row per text at least."""
    wanted = cut(asked.select("tid", "crc").distinct())
    return tokens.select("tid", "crc", "w").join(wanted, ["tid", "crc"], "left_semi")


def phrase_matches(tokens: DataFrame, phrases: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """(tid, crc, wid, start, length): every exact occurrence of every phrase, start from 0."""
    known, picked, index = _anchored(tokens, phrases, anchors)

    def of_rank(rank: int) -> DataFrame:
        return picked.filter(F.col("rank") == rank).select("wid", "off", "term")

    found = index.join(of_rank(1), "term").select(
        "wid", "tid", "crc", (F.col("pos") - F.col("off")).alias("start")).filter("start >= 0")
    for rank in range(2, anchors + 1):
        # Phrases of fewer words have no list of this rank and pass as they are.
        asked = found.join(of_rank(rank), "wid", "left").withColumn("pos", F.col("start") + F.col("off"))
        found = asked.filter("term is null").select("wid", "tid", "crc", "start").unionByName(
            asked.filter("term is not null").join(index, ["term", "tid", "crc", "pos"], "left_semi")
            .select("wid", "tid", "crc", "start"))
    found = cut(found)
    return found.join(known, "wid").join(_texts_of(tokens, found), ["tid", "crc"]) \
        .filter(F.slice("w", F.col("start") + 1, F.col("length")) == F.col("phrase")) \
        .select("tid", "crc", "wid", "start", "length").distinct()


def proximity_matches(tokens: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(tid, crc, wid, pos): occurrences of a phrase's rarest term near which, in any order, all its
    words stand within ``length + slop`` words."""
    known, picked, index = _anchored(tokens, phrases, 1)
    found = cut(index.join(picked, "term").select("wid", "tid", "crc", "pos"))
    span = F.col("length") + slop
    near = F.exists(F.sequence(F.greatest(F.lit(0), F.col("pos") - span + 1), F.col("pos")),
                    lambda s: F.size(F.array_except("phrase", F.slice("w", s + 1, span))) == 0)
    return found.join(known, "wid").join(_texts_of(tokens, found), ["tid", "crc"]) \
        .filter(near).select("tid", "crc", "wid", "pos").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, tid, crc, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a phrase is hit; a document is contaminated when at least one
    in twenty of its words is.  The digest covers the ids of the occurring items, sorted as
    strings and joined by commas (a null id is an empty string).  Other columns are ignored.
    """
    tokens = tokenised(docs)
    phrases = cut(phrases_of(items, window))
    matches = cut(phrase_matches(tokens, phrases))
    spans = matches.groupBy("tid", "crc", "start").agg((F.col("start") + F.max("length")).alias("end"))
    before = W.partitionBy("tid", "crc").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    hits = spans.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0))) \
        .groupBy("tid", "crc").agg(F.sum(F.greatest(
            F.lit(0), F.col("end") - F.greatest("start", "reached"))).cast("long").alias("n_hit"))
    occurring = matches.select("tid", "crc", "wid").distinct() \
        .join(phrases.select("wid", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")), "wid")
    # A list holds each benchmark item at most once.
    listed = occurring.groupBy("tid", "crc").agg(F.sort_array(F.collect_set("item")).alias("items"))
    judged = hits.join(listed, ["tid", "crc"])
    rows = tokens.select("doc_id", "tid", "crc", "n_words")
    return rows.join(judged, ["tid", "crc"], "left").select(
        "doc_id", "tid", "crc", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("_size"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256")) \
        .select("doc_id", "tid", "crc", "n_words", "n_hit",
                F.greatest(F.col("_size"), F.lit(0)).alias("n_items"), "items_sha256",
                ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


#: The contract's result over documents and benchmark.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
p AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM b WHERE len(w) > 0)),
runs AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT size FROM p)
  WHERE i + size - 1 <= len(w)),
m AS (SELECT runs.r, runs.i, runs.size, p.item_id FROM runs JOIN p USING (size, phrase)),
h AS (SELECT r, count(DISTINCT j) AS n_hit
      FROM (SELECT r, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT r, i, size FROM m)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
