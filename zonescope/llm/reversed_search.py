"""Ranked lexical search, reversed: the items are indexed, the documents stream by.

The items' terms form an inverted index (term -> items) of bounded size; it is
broadcast, in several blocks of items where they are many.  Each task counts a
document's terms, looks up those that some item has, and adds their weights to
the scores of the posted items; every item keeps a heap of its best documents.
The heaps of all tasks are merged in two steps.  Two passes over the
documents: one for the statistics of the collection (documents, terms, and the
document frequencies of the items' terms), one for the scores.

All sums are 64-bit integers, so scores do not depend on the order of terms,
tasks or partitions.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonescope.llm.common import byte_texts, id_and_text, ship, slices

TOP = 10
#: Terms of one broadcast block of items, in bytes (a single larger item is a block of its own).
BLOCK_BYTES = 32 << 20
#: Scores that a task holds at once while it adds up postings, and postings it adds up at once.
CELLS = 1 << 21
POSTINGS = 1 << 20
#: Piles into which a merge deals the heaps of all tasks first.
PILES = 64

#: Bytes outside terms become spaces, A-Z lower case; 0-9, a-z and all bytes of other letters stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


class _Index:
    """Terms of a block of items, with the items that hold each."""

    def __init__(self, items: list[list[bytes]]):
        postings: dict[bytes, list[int]] = {}
        for number, own in enumerate(items):
            for term in own:
                postings.setdefault(term, []).append(number)
        self.n_items = len(items)
        self.number = {term: i for i, term in enumerate(postings)}
        self.lengths = np.array([len(p) for p in postings.values()], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.items = np.array([i for p in postings.values() for i in p], np.int64)


_HELD: dict = {}


def _index(token: str, items) -> _Index:
    """The index of a broadcast block, built once per worker."""
    if token not in _HELD:
        _HELD.clear()
        _HELD[token] = _Index(items.value)
    return _HELD[token]


class _Heaps:
    """The best ``top`` documents of every item: higher scores first, then smaller ids, documents without an id last."""

    NO_ID = -(1 << 63) - 1

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        # The worst kept entry of full heaps; a score of 0 never enters.
        self.score = np.zeros(n_items, np.int64)
        self.rank = np.full(n_items, np.iinfo(np.int64).max)

    def offer(self, ids: list[int | None], scores: np.ndarray) -> None:
        """Scores: a row per document, a column per item."""
        ranks = [self.NO_ID if i is None else ~i for i in ids]
        near = np.array([max(r, -(1 << 63)) for r in ranks], np.int64)[:, None]
        better = (scores > 0) & ((scores > self.score) | ((scores == self.score) & (near >= self.rank)))
        for d, i in zip(*(axis.tolist() for axis in np.nonzero(better)), strict=True):
            heap, entry = self.heaps[i], (int(scores[d, i]), ranks[d])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.score[i] = heap[0][0]
                self.rank[i] = max(heap[0][1], -(1 << 63))


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with at least one term, in blocks whose terms are at most ``BLOCK_BYTES`` together."""
    total = items.agg(F.count("*"), F.sum("bytes"), F.max("bytes")).first()
    if not total[0]:
        return
    count = max(1, -(-total[1] // BLOCK_BYTES))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(count)))
        largest = dealt.groupBy("block").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0]
        if largest <= max(BLOCK_BYTES, total[2]) or count >= total[0] * 8:
            break
        count *= 2
    for block in range(count):
        rows = [(r.item_id, [bytes(t) for t in r.terms]) for r in dealt.where(F.col("block") == block).collect()]
        if rows:
            yield rows


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, terms, bytes): distinct terms of each item; rows of one id are one item."""
    ship(items.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(set(terms(t))) for t in byte_texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lists, pa.list_(pa.binary()))], names=["item_id", "terms"])

    split_up = id_and_text(items, item_col, text_col).mapInArrow(split, "item_id long, terms array<binary>")
    merged = split_up.select("item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(F.collect_set("term").alias("terms"))
    return merged.withColumn("bytes", F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.length(t) + 64))


def _statistics(docs: DataFrame, token: str, held) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the document frequency of each term of the block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(token, held)
        n_docs = n_terms = 0
        frequency: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in byte_texts(part):
                    words = terms(text)
                    if words:
                        n_docs += 1
                        n_terms += len(words)
                        frequency.update(index.number.keys() & set(words))
        keys = [-1, -2, *(index.number[t] for t in frequency)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([n_docs, n_terms, *frequency.values()], pa.int64())], names=["term", "n"])

    rows = docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row per term of the bounded block
    sums = {r.term: r.n for r in rows}
    frequencies = np.zeros(len(_Index(held.value).number), np.int64)
    for term, n in sums.items():
        if term >= 0:
            frequencies[term] = n
    return sums.get(-1, 0), sums.get(-2, 0), frequencies


def _score_block(docs: DataFrame, rows: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame:
    spark = docs.sparkSession
    token = uuid.uuid4().hex
    held = spark.sparkContext.broadcast([own for _, own in rows])
    item_ids = [i for i, _ in rows]
    n_docs, n_terms, frequencies = _statistics(docs, token, held)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in frequencies.tolist()], np.int64)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(token, held)
        heaps = _Heaps(index.n_items, top)
        most = max(1, min(32, CELLS // index.n_items))
        ids: list = []
        rows_, found, gains, waiting = [], [], [], 0

        def settle() -> None:
            nonlocal ids, rows_, found, gains, waiting
            scores = np.zeros((len(ids), index.n_items), np.int64)
            d, t, g = np.array(rows_, np.int64), np.array(found, np.int64), np.array(gains, np.int64)
            if len(t):
                g = g * weights[t]
                ends = np.cumsum(index.lengths[t])
                for begin in range(0, int(ends[-1]), POSTINGS):
                    a, b = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, min(begin + POSTINGS, ends[-1]) - 1, "right") + 1
                    place = np.arange(begin, min(begin + POSTINGS, int(ends[-1])))
                    which = a + np.searchsorted(ends[a:b], place, "right")
                    posted = index.items[index.begins[t[which]] + place - (ends[which] - index.lengths[t[which]])]
                    np.add.at(scores, (d[which], posted), g[which])
            heaps.offer(ids, scores)
            ids, rows_, found, gains, waiting = [], [], [], [], 0

        for batch in batches:
            for part in slices(batch):
                for doc, text in zip(part.column("doc_id").to_pylist(), byte_texts(part), strict=True):
                    words = terms(text)
                    if not words:
                        continue
                    counts = Counter(words)
                    m = 100 - 90 + (90 * len(words) * n_docs) // n_terms
                    for term in index.number.keys() & counts.keys():
                        tf = counts[term]
                        rows_.append(len(ids))
                        found.append(index.number[term])
                        gains.append((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                    ids.append(doc)
                    waiting += len(counts)
                    if len(ids) >= most or waiting >= POSTINGS:
                        settle()
        if ids:
            settle()
        out = [(item_ids[i], None if r == _Heaps.NO_ID else ~r, s) for i, heap in enumerate(heaps.heaps) for s, r in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["item_id", "doc_id", "score"])

    return docs.mapInArrow(rank, "item_id long, doc_id long, score long")


def _best(df: DataFrame, keys: list[str], top: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``top`` best documents of every item: item_id, rank, doc_id, score (above 0).

    An item's score of a document sums, over the item's distinct terms,
    ``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with
    ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and
    ``m = 10 + (90 * n * N) div L``: N documents with a term, L their terms, n
    the document's terms, df the documents with the term, tf its count there.
    Equal scores rank by ascending doc_id.

    Null and empty texts have no terms: such documents and items give no row.
    Every row of ``docs`` is a document, repeated ids included; a document
    without an id counts and ranks after its equals.  Item rows that share an
    id (or have none) are one item.  Other columns never reach the operator.
    No documents or no items: no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    slim = id_and_text(docs, id_col, text_col)
    schema = "item_id long, doc_id long, score long"
    found = spark.createDataFrame([], schema)
    for rows in _blocks(_item_terms(items, item_col, item_text_col)):
        found = found.unionByName(_score_block(slim, rows, top))
    piled = found.withColumn("_pile", F.pmod(F.spark_partition_id(), F.lit(PILES)))
    merged = _best(_best(piled, ["item_id", "_pile"], top, "_in_pile"), ["item_id"], top, "rank")
    return merged.select("item_id", "rank", "doc_id", "score")
