"""Ranked lexical search over an inverted index whose posting lists are blocked by document similarity.

Scores are sums over an item's terms of weight times impact, all in whole numbers (see ``ORACLE``).
The index keeps, of every text, the impacts of the terms that the items use.  Texts are ordered by
the sampled text to whose vector theirs is nearest, so that similar texts are neighbours, and stored in
pieces of at most ``PIECE`` neighbours.  In a piece each term's posting list is cut along that order into
blocks, and each block carries a summary: the maximum of every coordinate over its texts, rounded
up to a byte.

A search goes through the pieces one by one.  Of an item, lists whose largest impacts together
cannot reach the score of rank k found so far are left out; of the other lists a block is skipped
only when its summary's product with the item is below that score.  All texts of the blocks left are
scored in full.  Both bounds are upper bounds of exact scores, so the result is that of scoring
everything.  Every task passes on its best k of each item, and the best k of these are the answer.

Equal texts have one vector, in the index under the smallest doc_id; ranks are dealt to all copies.
The items of one pass are a bounded block (``ITEMS``); more items mean more passes over the index.

* A null or empty text has no terms: it counts for nothing and is never found.  Items without terms,
  an empty table of items or of documents give no rows; terms of weight 0 add nothing.
* Every row is a document: repeated rows rank one by one.  Equal scores go by doc_id, rows
  without one last.  Items with equal id and text are one item.
* Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellnote.llm.common import ascii_lower, cut, shared_folder, shuffle_partitions

TOP = 10
PIECE = 2048
#: Postings of a piece, which bound the size of its row.
POSTINGS = 1 << 15
#: Sampled texts around which the others are ordered, and buckets of terms in which they are compared.
CENTRES, HASHED = 256, 4096
#: Texts of a block; lists and rests of fewer than SHORT texts have no summary and are scored.
BLOCK, SHORT = 64, 6
#: Cells of the largest array that a piece is unpacked to: pieces over it are halved.
CELLS = 1 << 20
ITEMS = 2000
#: Impacts are at most 10**6: a byte of a summary stands for this much.
STEP = 4000
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_TERM), F.lit(0))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs inside: theirs are wide, and a batch is held as a whole."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ------------------------------------------------------------- index ----

def _counted(docs: DataFrame) -> DataFrame:
    """(tid, crc, no_id, id, n, terms, tfs) of every row; the first entry, an empty term, stands for the row itself."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.xxhash64(text).alias("tid"), F.crc32(text).alias("crc"), F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), text.alias("text"))
    pattern = _TERM.encode()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern).findall
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, ends, terms, tfs = [], [0], [], []
                for text in part.column(4).to_pylist():
                    words = find(text.lower())
                    counts = Counter(words)
                    sizes.append(len(words))
                    terms.append(b"")
                    terms.extend(counts)
                    tfs.append(len(words))
                    tfs.extend(counts.values())
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                     pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                    names=["tid", "crc", "no_id", "id", "n", "terms", "tfs"])

    return rows.mapInArrow(count, "tid long, crc long, no_id boolean, id long, n long, terms array<string>, tfs array<long>")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(tid, crc, no_id, id, n, term, tf), stored: occurrences of ``terms`` in every row, and one posting of
    the empty term for the row itself, whose tf is its number of terms."""
    wanted = terms.select("term").union(terms.sparkSession.createDataFrame([("",)], "term string")).distinct()
    listed = _counted(docs).select("tid", "crc", "no_id", "id", "n", F.inline(F.arrays_zip("terms", "tfs"))) \
        .toDF("tid", "crc", "no_id", "id", "n", "term", "tf")
    return cut(listed.join(cut(wanted), "term").select("tid", "crc", "no_id", "id", "n", "term", "tf"))


def _unit_rows(lists: pa.Array, impacts: np.ndarray) -> np.ndarray:
    """A row of length 1 for each list of terms: impacts summed into ``HASHED`` buckets of terms."""
    coded = pc.dictionary_encode(lists.flatten())
    bucket = np.array([int.from_bytes(blake2b(t.encode(), digest_size=4).digest()) % HASHED
                       for t in coded.dictionary.to_pylist()], np.int64)
    rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = np.bincount(rows * HASHED + bucket[coded.indices.to_numpy()], impacts, len(lists) * HASHED)
    dense = flat.reshape(-1, HASHED).astype(np.float32)
    return dense / np.maximum(np.sqrt((dense * dense).sum(1, keepdims=True)), 1e-9)


def _chained(rows: np.ndarray) -> np.ndarray:
    """The rows in an order in which each is the nearest to the one before among those left."""
    left, order = list(range(1, len(rows))), [0]
    while left:
        near = rows[left] @ rows[order[-1]]
        order.append(left.pop(int(np.argmax(near))))
    return rows[order]


def _impacts(found: DataFrame, rows: int, total: int) -> DataFrame:
    length = F.expr(f"25 + (cast(75 as decimal(38, 0)) * n * {rows}) div {max(total, 1)}")
    return found.filter("term <> ''").withColumn("m", length) \
        .withColumn("c", F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").cast("int"))


def placed_vectors(found: DataFrame, rows: int, total: int, centres: int = CENTRES) -> DataFrame:
    """(tid, crc, no_id, id, terms, impacts, centre, near), stored: every different text with postings,
    under its smallest id, and its place: the nearest of ``centres`` sampled texts and how near.

    ``rows`` and ``total``: documents with terms, and all their terms.  The sample is chosen by hashes and is
    bounded; it steers the order of the texts, any choice gives the same results.
    """
    names = ["tid", "crc", "no_id", "id"]
    first = cut(found.filter("term = '' and tf > 0").groupBy("tid", "crc")
                .agg(F.min(F.struct("no_id", "id")).alias("first")).select("tid", "crc", "first.no_id", "first.id"))

    def held(chosen: DataFrame) -> DataFrame:
        # Repeated rows of one id give equal entries, which a set holds once.
        return _impacts(found, rows, total).join(chosen, names).groupBy(*names) \
            .agg(F.collect_set(F.struct("term", "c")).alias("v")) \
            .select(*names, F.col("v.term").alias("terms"), F.col("v.c").alias("impacts"))

    some = held(cut(first.orderBy(F.xxhash64("tid", F.lit("centre")), "crc").limit(centres))).toArrow()
    if not some.num_rows:
        some = pa.table({"terms": pa.array([[""]]), "impacts": pa.array([[1]], pa.list_(pa.int32()))})
    lists, impacts = (some.column(c).combine_chunks() for c in ("terms", "impacts"))
    middle = _chained(_unit_rows(lists, impacts.flatten().to_numpy()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                near = _unit_rows(part.column(4), part.column(5).flatten().to_numpy()) @ middle.T
                best = near.argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(best.astype(np.int32)), pa.array(near[np.arange(len(best)), best])],
                    names=[*names, "terms", "impacts", "centre", "near"])

    with arrow_rows(found.sparkSession, 1024):
        return cut(held(first).mapInArrow(place, "tid long, crc long, no_id boolean, id long, terms array<string>, "
                                                 "impacts array<int>, centre int, near float"))


def _blocked(names: list, terms: pa.Array, ends: np.ndarray, impacts: np.ndarray, piece: int, cells: int,
             block: int) -> Iterator[dict]:
    """Index rows of neighbouring texts: ``names`` are their (tid, crc, no_id, id)."""
    n = len(names)
    coded = pc.dictionary_encode(terms)
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int32)
    if n > piece or n > 1 and (n * len(words) > cells or len(at) > POSTINGS):
        half = min(piece, (n + 1) // 2) if n <= piece else piece
        cut_at = ends[half]
        yield from _blocked(names[:half], terms[:cut_at], ends[:half + 1], impacts[:cut_at], piece, cells, block)
        yield from _blocked(names[half:], terms[cut_at:], ends[half:] - cut_at, impacts[cut_at:], piece, cells, block)
        return
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(ends))
    level = np.zeros((n, len(words)), np.uint8)
    level[rows, at] = -(-impacts // STEP)
    order = np.argsort(at, kind="stable")
    starts = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(words)))))
    of_term, block_ends, bits, levels = [], [0], [], []
    listed = rows[order]
    for t in range(len(words)):
        for lo in range(starts[t], starts[t + 1], block):
            hi = min(lo + block, starts[t + 1])
            of_term.append(t)
            block_ends.append(hi)
            if hi - lo >= SHORT:
                top = level[listed[lo:hi]].max(axis=0)
                bits.append(np.packbits(top > 0))
                levels.append(top[top > 0])
    raw = lambda parts: np.concatenate(parts).tobytes() if parts else b""
    yield {"tid": [x[0] for x in names], "crc": [x[1] for x in names], "no_id": [x[2] for x in names],
           "id": [x[3] for x in names], "words": words, "ends": ends.astype(np.int64).tobytes(), "at": at.tobytes(),
           "impacts": impacts.astype(np.int32).tobytes(), "listed": listed.tobytes(),
           "of_term": np.array(of_term, np.int32).tobytes(), "block_ends": np.array(block_ends, np.int64).tobytes(),
           "bits": raw(bits), "levels": raw(levels)}


_INDEX = pa.schema([("tid", pa.list_(pa.int64())), ("crc", pa.list_(pa.int64())), ("no_id", pa.list_(pa.bool_())),
                    ("id", pa.list_(pa.int64())), ("words", pa.list_(pa.string()))] +
                   [(c, pa.binary()) for c in ("ends", "at", "impacts", "listed", "of_term", "block_ends", "bits", "levels")])
_INDEX_SQL = "tid array<long>, crc array<long>, no_id array<boolean>, id array<long>, words array<string>, " \
             "ends binary, at binary, impacts binary, listed binary, of_term binary, block_ends binary, bits binary, levels binary"


def blocked_index(placed: DataFrame, piece: int = PIECE, cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """The vectors as index rows, stored: one row a piece of neighbours, with its posting lists in
    blocks and their summaries."""
    order = ["centre", "near", "id", "tid"]
    dealt = placed.repartitionByRange(shuffle_partitions(placed.sparkSession), *order) \
        .sortWithinPartitions(*order).select("tid", "crc", "no_id", "id", "terms", "impacts")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def pieces() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            names = list(zip(*[table.column(c).to_pylist() for c in ("tid", "crc", "no_id", "id")]))
            lists, values = (table.column(c).combine_chunks() for c in ("terms", "impacts"))
            ends = np.cumsum(np.concatenate(([0], pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
            for row in _blocked(names, lists.flatten(), ends, values.flatten().to_numpy(), piece, cells, block):
                yield pa.RecordBatch.from_pylist([row], schema=_INDEX)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, piece - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == piece:
                    yield from pieces()
                    held, rows = [], 0
        if held:
            yield from pieces()

    with arrow_rows(placed.sparkSession, 1024):
        # Values of megabytes: zstd needs no buffers of that size outside of the heap.
        return cut(dealt.mapInArrow(build, _INDEX_SQL), compression="zstd")


# ------------------------------------------------------------ search ----

class Piece:
    """An index row unpacked."""

    def __init__(self, row: dict) -> None:
        self.names = list(zip(row["no_id"], row["id"], row["tid"], row["crc"]))
        of = lambda c, kind: np.frombuffer(row[c], kind)
        self.number = {w: k for k, w in enumerate(row["words"])}
        width, n = len(self.number), len(self.names)
        ends, at = of("ends", np.int64), of("at", np.int32)
        self.impacts = np.zeros((n, width), np.int32)
        self.impacts[np.repeat(np.arange(n), np.diff(ends)), at] = of("impacts", np.int32)
        self.most = self.impacts.max(axis=0).astype(np.int64)
        self.listed, self.block_ends = of("listed", np.int32), of("block_ends", np.int64)
        of_term = of("of_term", np.int32)
        self.blocks = np.searchsorted(of_term, np.arange(width + 1))
        summed = np.diff(self.block_ends) >= SHORT
        self.summary = np.where(summed, np.cumsum(summed) - 1, -1)
        bits = of("bits", np.uint8).reshape(-1, -(-width // 8))
        there = np.unpackbits(bits, axis=1)[:, :width].astype(bool)
        self.levels = np.zeros(there.shape, np.uint8)
        self.levels[there] = of("levels", np.uint8)


class Best:
    """The best ``top`` texts of an item so far: score falling, then ids rising, none last."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []

    @property
    def bar(self) -> int:
        """Texts under this score are not wanted; those that reach it may be."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, names: list[tuple]) -> None:
        self.rows = sorted(self.rows + [(-int(s), *x) for s, x in zip(scores, names)])[:self.top]


def search_piece(piece: Piece, terms: list[str], weights: np.ndarray, best: Best) -> tuple[int, int]:
    """Adds the piece's texts to ``best``; returns how many blocks were met and how many were skipped.
    ``weights`` are whole numbers over 0, one a term."""
    known = [(piece.number[t], w) for t, w in zip(terms, weights) if t in piece.number]
    if not known:
        return 0, 0
    at, weight = np.array([k for k, _ in known]), np.array([w for _, w in known], np.int64)
    most = weight * piece.most[at]
    if most.sum() < best.bar:
        return 0, 0
    # Texts only in lists that cannot reach the bar together need no look.
    order = np.argsort(most, kind="stable")
    needed = at[order][np.cumsum(most[order]) >= best.bar]
    blocks = np.concatenate([np.arange(piece.blocks[t], piece.blocks[t + 1]) for t in needed])
    own = piece.summary[blocks]
    bound = np.full(len(blocks), most.sum())
    bound[own >= 0] = np.minimum(bound[own >= 0], piece.levels[own[own >= 0]][:, at].astype(np.int64) @ (weight * STEP))
    order = np.argsort(-bound, kind="stable")
    blocks, bound = blocks[order], bound[order]
    seen = np.zeros(len(piece.names), bool)
    done, step = 0, 4
    while done < len(blocks) and bound[done] >= best.bar:
        some = blocks[done: done + step][bound[done: done + step] >= best.bar]
        done += len(some)
        step *= 2
        rows = np.unique(np.concatenate([piece.listed[piece.block_ends[b]: piece.block_ends[b + 1]] for b in some]))
        rows = rows[~seen[rows]]
        seen[rows] = True
        scores = piece.impacts[np.ix_(rows, at)].astype(np.int64) @ weight
        good = np.flatnonzero(scores >= best.bar)
        if len(good) > best.top:
            # Ties of the last place stay.
            good = good[scores[good] >= -np.partition(-scores[good], best.top - 1)[best.top - 1]]
        best.add(scores[good], [piece.names[r] for r in rows[good].tolist()])
    return len(blocks), len(blocks) - done


def _search(index: DataFrame, items: list[tuple[int, list[str], list[int]]], top: int) -> DataFrame:
    """(item, score, no_id, id, tid, crc): each task's best ``top`` texts of every item."""
    names = ["item", "score", "no_id", "id", "tid", "crc"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(key, terms, np.array(weights, np.int64), Best(top)) for key, terms, weights in items]
        for batch in batches:
            for k in range(batch.num_rows):
                piece = Piece(batch.slice(k, 1).to_pylist()[0])
                for _, terms, weights, best in asked:
                    search_piece(piece, terms, weights, best)
        rows = [(key, -r[0], *r[1:]) for key, _, _, best in asked for r in best.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    return index.mapInArrow(search, "item long, score long, no_id boolean, id long, tid long, crc long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, at_once: int = ITEMS, piece: int = PIECE,
           cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score over 0."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    asked = cut(items.select("item_id", text.alias("text")).distinct()
                .select("item_id", F.xxhash64(F.col("item_id").isNull(), F.col("item_id").cast("string"), "text").alias("item"),
                        terms_of(F.col("text")).alias("w")))
    wanted = asked.select("item", F.explode("w").alias("term")).groupBy("item", "term").agg(F.count("*").alias("q"))
    wanted = cut(wanted)
    found = postings(docs, wanted.select("term"))
    size = found.filter("term = ''").agg(F.count(F.when(F.col("tf") > 0, 1)).alias("rows"), F.sum("tf").alias("total")).first()
    rows, total = size["rows"], size["total"] or 0
    weight = F.floor(1000 * F.log(F.lit(2.0 * rows + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = found.filter("term <> ''").groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("w"))
    weighed = cut(wanted.join(weights, "term").select("item", "term", (F.col("q") * F.col("w")).alias("w")).filter("w > 0")
                  .groupBy("item").agg(F.collect_list(F.struct("term", "w")).alias("v")))
    index = blocked_index(placed_vectors(found, rows, total), piece, cells, block)
    parts = max(1, -(-weighed.count() // at_once))
    path = f"{shared_folder(spark)}/wellnote-{uuid.uuid4().hex}"
    for part in range(parts):
        # About at_once items of the driver's at a time.
        some = [(r["item"], [x["term"] for x in r["v"]], [x["w"] for x in r["v"]])
                for r in weighed.filter(F.pmod("item", F.lit(parts)) == part).collect()]
        with arrow_rows(spark, 4):
            _search(index, some, top).write.mode("append").parquet(path)
    texts = spark.read.schema("item long, score long, no_id boolean, id long, tid long, crc long").parquet(path)
    order = [F.col("score").desc(), "no_id", "id", "tid", "crc"]
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    texts = cut(texts.withColumn("at", place).filter(F.col("at") <= top).select("item", "score", "tid", "crc"))
    # No more than top copies of a text can be wanted.
    copies = found.filter("term = ''").select("tid", "crc", "no_id", "id") \
        .join(texts.select("tid", "crc").distinct(), ["tid", "crc"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("tid", "crc").orderBy("no_id", "id"))
    copies = copies.withColumn("nth", nth).filter(F.col("nth") <= top).drop("nth")
    dealt = texts.join(copies, ["tid", "crc"]).withColumn("rank", place).filter(F.col("rank") <= top)
    return dealt.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", F.when(~F.col("no_id"), F.col("id")).cast(kind).alias("doc_id"), "score")


#: The contract's result over documents and benchmark.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
q AS (
  SELECT item_id, term, count(*) AS k
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
t AS (SELECT r, doc_id, n, term, count(*) AS tf
      FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
c AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS impact FROM t, s),
e AS (SELECT item_id, r, doc_id, CAST(sum(k * weight * impact) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN c USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM e WHERE score > 0)
WHERE rank <= 10
"""
