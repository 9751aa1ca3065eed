"""Ranked lexical search with hashed max-sketches.

First every document becomes a row of the index: its number of terms, and which terms of
the asked items it holds how often. Counts over all documents give each term its weight.
Then a task takes tiles of index rows. The impacts of a document's terms fold into a sketch
of ``width`` coordinates: a term hashes to one, and a coordinate keeps the largest impact
that falls on it. What a document can score for an item is at most the sum of the
coordinates of the item's terms; one matrix product looks that up for all items of a
batch. For each item the documents are scored exactly by descending bound, from the
postings, until the next bound is below the k-th best score found so far. Documents whose
bound equals it are still scored, so ties go to the smaller id.

A search over a share of the index comes first: its k-th best scores are lower limits that
all tasks start from, so a task gives out few rows that do not reach the end. The share
only decides how soon bounds bite; every document is bounded, whatever the share.

Terms are named by 64-bit hashes. The terms of items are broadcast in batches of bounded
text; more items make more passes over the index.

Defined cases: a null or empty text has no terms, counts in no statistic and is never
found; an item without terms finds nothing; rows that repeat an id are documents (or items)
of their own; a null doc_id comes after all others of its score; without documents or items
there are no rows; terms of weight 0 add nothing, and only scores above 0 are listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docstrata.llm.tables import Scratch, pick
from docstrata.llm.words import Hasher, Words, alphanumeric, buffers, chunks, mix, signed

K = 50
WIDTH = 1024
#: Items of so many bytes of text, and no more than so many items, are searched at once.
BATCH_BYTES = 4 << 20
BATCH_ITEMS = 1024
#: One in so many documents is searched first.
SHARE = 32
SEED = 0x1E81
_TILE = 2048
_EXACT = 1 << 62

_INDEX = "doc_id bigint, n bigint, terms array<int>, times array<bigint>"


def terms_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For ranges of texts: the first row, the hashes of all terms, and where the terms of
    each row start."""
    hasher = Hasher(alphanumeric(), SEED, fold=True)
    data, offsets = buffers(texts)
    for low, high in chunks(offsets):
        words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], alphanumeric())
        yield low, words.hashes(hasher), words.first


@dataclass(frozen=True)
class Items:
    """A batch of items: their ids, the distinct terms of all of them, and the numbers of
    the terms of each (``first`` has where they start)."""

    ids: list
    terms: np.ndarray
    first: np.ndarray
    members: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str | None]) -> Items:
        own = []
        for _, hashes, first in terms_of(pa.array(texts, pa.string())):
            own += [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]))
        first = np.cumsum([0, *(len(o) for o in own)])
        members = np.searchsorted(terms, np.concatenate([np.zeros(0, np.uint64), *own]))
        return cls(ids, terms, first, members)


def _postings(items):
    """Rows (doc_id, text) to rows of the index; texts without terms give none."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value.terms
        for batch in batches:
            for low, hashes, first in terms_of(batch["text"]):
                n = np.diff(first)
                row = np.repeat(np.arange(len(n)), n)
                if len(known):
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    found = known[at] == hashes
                else:
                    at, found = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
                pairs, times = np.unique(row[found] * max(1, len(known)) + at[found], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(len(n) + 1) * max(1, len(known))).astype(np.int32)
                terms = pa.ListArray.from_arrays(ends, pa.array((pairs % max(1, len(known))).astype(np.int32)))
                counts = pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64)))
                columns = [batch["doc_id"].slice(low, len(n)), pa.array(n.astype(np.int64)), terms, counts]
                rows = pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])
                yield rows.filter(pa.array(n > 0))

    return postings


@dataclass(frozen=True)
class Search:
    """What tasks need to score: the items, the weight of each term, the counts of all
    documents and terms, and a lower limit for the k-th best score of each item."""

    items: Items
    weights: np.ndarray
    documents: int
    length: int
    k: int
    width: int
    least: np.ndarray

    @property
    def coordinates(self) -> np.ndarray:
        """Where each term falls in a sketch."""
        return (mix(self.items.terms) % np.uint64(self.width)).astype(np.int64)

    def lookup(self) -> np.ndarray:
        """How often each coordinate (row) is asked for by each item (column)."""
        out = np.zeros((self.width, len(self.items.ids)))
        item = np.repeat(np.arange(len(self.items.ids)), np.diff(self.items.first))
        np.add.at(out, (self.coordinates[self.items.members], item), 1)
        return out

    def impacts(self, n: np.ndarray, row: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """What each posting adds to a score."""
        m = np.array([50 + (50 * int(x) * self.documents) // self.length for x in n.tolist()], object)
        weights = self.weights[terms]
        largest = int(m.max(initial=0)), int(times.max(initial=0)), int(weights.max(initial=0))
        if max(1000 * largest[1] + 20 * largest[0], 10**9 * largest[1], 10**6 * largest[2]) < _EXACT:
            m = m.astype(np.int64)
            return weights * ((10**9 * times) // (1000 * times + 20 * m[row]))
        times, weights = times.astype(object), weights.astype(object)
        return (weights * ((10**9 * times) // (1000 * times + 20 * m[row]))).astype(np.int64)


class Best:
    """The best documents of every item that a task has met."""

    def __init__(self, search: Search):
        self.search = search
        self.lookup = search.lookup()
        self.coordinates = search.coordinates
        count = len(search.items.ids)
        self.least = search.least.copy()
        self.scores = [np.zeros(0, np.int64) for _ in range(count)]
        self.docs = [np.zeros(0, np.int64) for _ in range(count)]
        self.named = [np.zeros(0, bool) for _ in range(count)]

    def sketch(self, rows: int, row: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """The largest impact of each document in each coordinate."""
        out = np.zeros((rows, self.search.width))
        order = np.argsort(impacts, kind="stable")  # of several on one place the last one stays
        out[row[order], self.coordinates[terms[order]]] = impacts[order]
        return out

    def meet(self, docs, named, n, first, terms, times) -> None:
        row = np.repeat(np.arange(len(n)), np.diff(first))
        impacts = self.search.impacts(n, row, terms, times)
        # Sums of whole numbers, rounded up where a double cannot hold them.
        bounds = (self.sketch(len(n), row, terms, impacts) @ self.lookup) * (1 + 1e-12)
        items = self.search.items
        asked = np.zeros(len(items.terms), bool)
        for item in np.flatnonzero((bounds >= self.least).any(axis=0)).tolist():
            own = items.members[items.first[item] : items.first[item + 1]]
            asked[own] = True
            bound = bounds[:, item]
            left = np.flatnonzero(bound >= self.least[item])
            left = left[np.argsort(-bound[left], kind="stable")]
            at = 0
            while at < len(left) and bound[left[at]] >= self.least[item]:
                part = left[at : at + self.search.k]
                self._offer(item, docs[part], named[part], exact_scores(part, first, terms, impacts, asked))
                at += len(part)
            asked[own] = False

    def _offer(self, item: int, docs: np.ndarray, named: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least[item]
        scores = np.concatenate([self.scores[item], scores[good]])
        docs = np.concatenate([self.docs[item], docs[good]])
        named = np.concatenate([self.named[item], named[good]])
        order = np.lexsort((docs, ~named, -scores))[: self.search.k]
        self.scores[item], self.docs[item], self.named[item] = scores[order], docs[order], named[order]
        if len(order) == self.search.k:
            self.least[item] = max(self.least[item], scores[order[-1]])


def exact_scores(
    rows: np.ndarray, first: np.ndarray, terms: np.ndarray, impacts: np.ndarray, asked: np.ndarray
) -> np.ndarray:
    """The sums of the impacts of the asked terms of some rows."""
    sizes = first[rows + 1] - first[rows]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[rows] - (ends - sizes), sizes)
    total = np.concatenate([[0], np.cumsum(np.where(asked[terms[at]], impacts[at], 0))])
    return total[ends] - total[ends - sizes]


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(shared.value)
        for batch in batches:
            for low in range(0, len(batch), _TILE):
                part = batch.slice(low, _TILE)
                named = part["doc_id"].is_valid().to_numpy(zero_copy_only=False)
                docs = part["doc_id"].fill_null(0).to_numpy()
                first = part["terms"].offsets.to_numpy()
                first = first[: len(part) + 1]
                terms = part["terms"].flatten().to_numpy()
                times = part["times"].flatten().to_numpy()
                best.meet(docs, named, part["n"].to_numpy(), (first - first[0]).astype(np.int64), terms, times)
        item = np.repeat(np.arange(len(best.docs)), [len(d) for d in best.docs])
        if len(item):
            docs, named = np.concatenate(best.docs), np.concatenate(best.named)
            columns = [
                pa.array(item.astype(np.int32)),
                pa.array(docs, pa.int64(), mask=~named),
                pa.array(np.concatenate(best.scores)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return search


def _found(index: DataFrame, search: Search) -> DataFrame:
    """item (its number), rank, doc_id and score of the best documents of an index."""
    shared = index.sparkSession.sparkContext.broadcast(search)
    met = index.mapInArrow(_search(shared), "item int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = met.where("score > 0").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= search.k).select("item", "rank", "doc_id", "score")


def batches(items: DataFrame, batch_bytes: int = BATCH_BYTES, batch_items: int = BATCH_ITEMS) -> Iterator[DataFrame]:
    """Items (item_id, text) in parts of bounded size, dealt by hash; a single item is
    held whole."""
    rows = pick(items, "item_id", "text")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    total, count = rows.agg(size, F.count(F.lit(1))).first()
    parts = max(1, -(-2 * (total or 0) // batch_bytes), -(-2 * count // batch_items))
    parts = 1 if parts <= 2 else parts
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts).cast("long"))
    for number in range(parts):
        yield rows.where(place == number)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = K, width: int = WIDTH, share: int = SHARE
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for part in batches(items):
        asked = sorted(part.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        batch = Items.of([r["item_id"] for r in asked], [r["text"] for r in asked])
        shared = spark.sparkContext.broadcast(batch)
        index = scratch.write(texts.mapInArrow(_postings(shared), _INDEX))
        documents, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        held = index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
        weights = np.zeros(len(batch.terms), np.int64)
        for r in held.collect():
            weights[r["t"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))
        # A score of 0 is no find, so 1 is a lower limit for all.
        least = np.ones(len(asked), np.int64)
        search = Search(batch, weights, documents, length or 1, k, width, least)
        if share > 1:
            some = index.where(F.pmod(F.xxhash64("doc_id"), F.lit(share).cast("long")) == 0)
            for r in _found(some, search).where(F.col("rank") == k).collect():
                least[r["item"]] = r["score"]
        schema = part.select("item_id").schema
        names = [(number, item_id) for number, item_id in enumerate(batch.ids)]
        named = spark.createDataFrame(names, f"item int, item_id {schema[0].dataType.simpleString()}")
        found = scratch.write(_found(index, search).join(F.broadcast(named), "item"))
        found = found.select("item_id", "rank", "doc_id", "score")
        scratch.drop(index)
        shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out
