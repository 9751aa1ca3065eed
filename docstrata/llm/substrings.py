"""Substring de-duplication by recompression.

Words are symbols named by hashes. A round names runs of equal symbols, then deals the
symbols by a hash bit into left and right ones and names every pair of a left and a
right neighbour. What becomes of a symbol depends on its neighbours only, and each
symbol carries the stretch of words (its context) that decided over it: equal stretches
get equal symbols, in whatever document they lie, without a common dictionary.

A window of 50 words is represented by the longest symbol whose context lies within
it, the first by hash among equally long ones; windows in a row share theirs, so a
document sends one row for some twenty words. A window without such a symbol (a long
run of one word, say) represents itself, so no window goes missing. Symbols whose
context occurs in one document only end there. For the others, stretches of windows
that are equal as a whole are settled by the smallest document that has them; only the
first document of each different stretch is compared window by window. Stretches that
follow one another in a document are chained into runs: what is settled reaches a document
once per run, however many stretches a common passage has.

Defined cases: a null or empty text has no words and loses none; documents of fewer
words than the window lose none; repeated rows of a doc_id get the same result and do
not remove each other; a null doc_id counts as larger than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import Scratch, disclose, enclose, inner, pick, small_side
from docstrata.llm.words import Hasher, Spans, Words, buffers, chunks, mix, not_space, signed, stream

WINDOW = 50
ROUNDS = 5
LONGEST_RUN = 3
LONGEST_SYMBOL = 16
SEED = 0x5B57
#: A key of more rows than this is common, unless there are more than so many such keys.
HOT_ROWS = 5_000
HOT_KEYS = 100_000
_LAST = (1 << 63) - 1

_ANCHOR = "doc bigint, t bigint, key bigint, s1 bigint, s2 bigint, start int, size int"
_RUNS = (
    "array<struct<start:int,r1:bigint,r2:bigint,"
    "parts:array<struct<offset:int,size:int,key:bigint,s1:bigint,s2:bigint>>>>"
)
_KEPT = "struct<n_words:bigint,n_removed:bigint,kept:string>"


class Symbols:
    """A parse of the words of some documents, one round after the other.

    ``start`` and ``end`` are the words a symbol stands for, ``low`` and ``high`` its
    context; a context that depends on where the document begins or ends reaches
    beyond it. ``row`` is the document.
    """

    def __init__(self, names: np.ndarray, first: np.ndarray):
        n = len(names)
        self.names = names
        self.start = np.arange(n)
        self.end = self.start + 1
        self.low, self.high = self.start.copy(), self.end.copy()
        self.row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.first = first

    def __len__(self) -> int:
        return len(self.names)

    def _same_row(self) -> np.ndarray:
        """Whether a symbol and the next one lie in one document."""
        return self.row[1:] == self.row[:-1]

    def _outer_low(self) -> np.ndarray:
        """Where the context of the symbol before begins."""
        out = np.empty_like(self.low)
        out[1:] = np.where(self._same_row(), self.low[:-1], self.first[self.row[1:]] - 1)
        out[:1] = self.first[self.row[:1]] - 1
        return out

    def _outer_high(self) -> np.ndarray:
        """Where the context of the symbol after ends."""
        out = np.empty_like(self.high)
        out[:-1] = np.where(self._same_row(), self.high[1:], self.first[self.row[:-1] + 1] + 1)
        out[-1:] = self.first[self.row[-1:] + 1] + 1
        return out

    def _merge(self, heads: np.ndarray, sizes: np.ndarray, names: np.ndarray) -> None:
        """Symbols from each of ``heads`` on, ``sizes`` of them, become one."""
        last = heads + sizes - 1
        self.names = names
        self.start, self.end = self.start[heads], self.end[last]
        self.low, self.high = self.low[heads], self.high[last]
        self.row = self.row[heads]

    def name_runs(self, longest: int, seed: int) -> None:
        """Runs of up to ``longest`` equal symbols get one name. Where a run begins and
        ends, also one of a single symbol, depends on the symbols around it."""
        if not len(self):
            return
        equal = (self.names[1:] == self.names[:-1]) & self._same_row()
        heads = np.flatnonzero(np.concatenate([[True], ~equal]))
        sizes = np.diff(np.append(heads, len(self)))
        of = np.repeat(np.arange(len(heads)), sizes)
        self.low, self.high = self._outer_low()[heads][of], self._outer_high()[heads + sizes - 1][of]
        short = sizes <= longest
        heads = np.flatnonzero(~short[of] | np.concatenate([[True], ~equal]))
        sizes = np.diff(np.append(heads, len(self)))
        names = self.names[heads]
        one = mix(names * np.uint64(0x9E3779B97F4A7C15) + sizes.astype(np.uint64) + np.uint64(seed))
        self._merge(heads, sizes, np.where(sizes > 1, one, names))

    def name_pairs(self, longest: int, seed: int) -> None:
        """A left symbol and the right one after it get one name, of at most
        ``longest`` words."""
        if not len(self):
            return
        left = (mix(self.names ^ np.uint64(seed)) & np.uint64(1)).astype(bool)
        size = self.end - self.start
        pair = left[:-1] & ~left[1:] & self._same_row() & (size[:-1] + size[1:] <= longest)
        joins_next = np.append(pair, False)
        joined = np.append(False, pair)
        alone = ~joins_next & ~joined
        low, high = self._outer_low(), self._outer_high()
        self.low = np.where(alone & ~left, low, self.low)
        self.high = np.where(alone & left, high, self.high)
        heads = np.flatnonzero(~joined)
        sizes = 1 + joins_next[heads]
        names = self.names[heads]
        second = self.names[heads + sizes - 1]
        one = mix(mix(names + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15) + second)
        self._merge(heads, sizes, np.where(sizes > 1, one, names))


def parse(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    symbols = Symbols(names, first)
    for number, seed in enumerate(stream(SEED, rounds).tolist()):
        if number < 2:
            symbols.name_runs(LONGEST_RUN, seed)
        symbols.name_pairs(LONGEST_SYMBOL, seed)
    return symbols


def represent(symbols: Symbols, starts: np.ndarray, window: int) -> np.ndarray:
    """For each window start the number of its symbol, or -1."""
    from_ = np.searchsorted(symbols.low, starts, side="left")
    to = np.searchsorted(symbols.high, starts + window, side="right")
    out = np.full(len(starts), -1)
    some = np.flatnonzero(to > from_)
    if not len(some):
        return out
    size = (symbols.end - symbols.start).astype(np.uint64)
    order = np.argsort(((~size & np.uint64(0xFF)) << np.uint64(56)) | (mix(symbols.names) >> np.uint64(8)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    from_, to = from_[some], to[some]
    level = np.frexp((to - from_).astype(float))[1] - 1
    lowest = np.empty(len(some), np.int64)
    table = rank
    for power in range(int(level.max()) + 1):
        if power:
            step = 1 << (power - 1)
            table = np.minimum(table[:-step], table[step:])
        at = np.flatnonzero(level == power)
        lowest[at] = np.minimum(table[from_[at]], table[to[at] - (1 << power)])
    out[some] = order[lowest]
    return out


def _words(data: np.ndarray, offsets: np.ndarray, low: int, high: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of some rows and two independent hashes of each."""
    words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], not_space())
    return words, words.hashes(_HASHER[0]), words.hashes(_HASHER[1])


_HASHER = (Hasher(not_space(), SEED + 1), Hasher(not_space(), SEED + 2))


def _starts(first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All window starts of documents whose words begin at ``first``, and their rows."""
    counts = np.maximum(np.diff(first) - window + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[row] + within, row


def _anchors(window: int, rounds: int):
    """Rows (doc, t, text) to the stretches of windows with a common symbol."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch["text"])
            doc, t = batch["doc"].to_numpy(), batch["t"].to_numpy()
            for low, high in chunks(offsets):
                words, one, two = _words(data, offsets, low, high)
                starts, row = _starts(words.first, window)
                if not len(starts):
                    continue
                symbols = parse(one, words.first, rounds)
                chosen = represent(symbols, starts, window)
                spans, others = Spans(one, SEED + 3), Spans(two, SEED + 4)
                key = spans(
                    np.where(chosen < 0, starts, symbols.low[chosen]),
                    np.where(chosen < 0, starts + window, symbols.high[chosen]),
                )
                same = (row[1:] == row[:-1]) & (chosen[1:] == chosen[:-1]) & (key[1:] == key[:-1])
                heads = np.flatnonzero(np.concatenate([[True], ~same]))
                sizes = np.diff(np.append(heads, len(starts)))
                begin, end = starts[heads], starts[heads] + sizes - 1 + window
                rows = row[heads]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[low + rows]),
                        pa.array(t[low + rows]),
                        pa.array(signed(key[heads])),
                        pa.array(signed(spans(begin, end))),
                        pa.array(signed(others(begin, end))),
                        pa.array((begin - words.first[rows]).astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                    ],
                    ["doc", "t", "key", "s1", "s2", "start", "size"],
                )

    return anchors


def _windows(window: int):
    """Rows (m, text, spans) to one row per window of each span: (key, s1, s2, m, at, g1, g2)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch["text"])
            of_row = batch["spans"].to_pylist()
            docs = batch["m"].to_pylist()
            for low, high in chunks(offsets):
                words, one, two = _words(data, offsets, low, high)
                listed = [(r, s) for r in range(low, high) for s in of_row[r]]
                size = np.array([s["size"] for _, s in listed])
                of = np.repeat(np.arange(len(listed)), size)
                at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                begin = np.array([words.first[r - low] + s["start"] for r, s in listed])[of] + at
                columns = [np.array([s[c] for _, s in listed])[of] for c in ("key", "s1", "s2")]
                columns += [np.array([docs[r] for r, _ in listed])[of], at.astype(np.int32)]
                spans = Spans(one, SEED + 3), Spans(two, SEED + 4)
                columns += [signed(s(begin, begin + window)) for s in spans]
                names = ["key", "s1", "s2", "m", "at", "g1", "g2"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return windows


def _remove(window: int):
    def remove(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        total, removed, kept = [], [], []
        for text, cut in zip(texts, cuts, strict=True):
            words = (text.as_py() or "").encode().split()
            gone = 0
            if cut.is_valid:
                steps = np.zeros(len(words) + 1, np.int64)
                for c in cut.as_py():
                    at = np.arange(c["size"]) if c["at"] is None else np.array(c["at"], np.int64)
                    np.add.at(steps, c["start"] + at, 1)
                    np.add.at(steps, c["start"] + at + window, -1)
                keep = np.cumsum(steps[:-1]) == 0
                gone = len(words) - int(keep.sum())
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            total.append(len(words) + gone)
            removed.append(gone)
            kept.append(b" ".join(words).decode())
        columns = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_removed", "kept"])

    return arrow_udf(remove, _KEPT)


def repeated(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """What to cut: (doc, t, cuts), the window starts of each text that a smaller
    document has too. ``t`` is the hash of the text."""
    scratch = Scratch(docs.sparkSession, "substrings")
    texts = _identified(docs)
    anchors = scratch.write(texts.mapInArrow(_anchors(window, rounds), _ANCHOR))
    ends = F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("c")
    shared = scratch.write(anchors.groupBy("key").agg(*ends).where("lo < hi").select("key", "c"))
    found = scratch.write(_met(anchors, shared, ["key"], "left_semi").distinct())
    scratch.drop(anchors)
    span = ["key", "s1", "s2", "size"]
    place = F.min(F.struct("doc", "t", "start")).alias("p")
    spans = scratch.write(found.groupBy(*span).agg(place).select(*span, F.expr("p.doc AS m"), "p.t", "p.start"))
    several = scratch.write(spans.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    open_ = _met(spans, several, ["key"], "left_semi").groupBy("m", "t")
    open_ = scratch.write(open_.agg(F.collect_list(F.struct(*span, "start")).alias("spans")))
    wanted = small_side(open_.select(F.col("m").alias("doc"), "t"), 16)
    sources = texts.join(wanted, ["doc", "t"], "left_semi").groupBy("doc", "t").agg(F.first("text").alias("text"))
    sources = sources.withColumnRenamed("doc", "m").join(open_, ["m", "t"]).select("m", "text", "spans")
    windows = scratch.write(
        sources.mapInArrow(
            _windows(window), "key bigint, s1 bigint, s2 bigint, m bigint, at int, g1 bigint, g2 bigint"
        )
    )
    least = windows.groupBy("g1", "g2").agg(F.min("m").alias("least"), F.max("m").alias("most"), F.count(F.lit(1)).alias("c"))
    least = scratch.write(least.where("least < most").drop("most"))
    later = _met(windows, least, ["g1", "g2"], "inner").where("least < m")
    later = later.groupBy("key", "s1", "s2").agg(F.collect_set("at").alias("at"))
    settled = scratch.write(
        spans.select("key", "s1", "s2", "m").join(later, ["key", "s1", "s2"], "left")
    )
    parts = F.collect_list(F.struct("start", "size", "key", "s1", "s2"))
    chained = found.groupBy("doc", "t").agg(arrow_udf(_chain, _RUNS)(parts).alias("runs"))
    runs = scratch.write(chained.select("doc", "t", F.inline("runs")))
    different = runs.groupBy("r1", "r2").agg(F.first("parts").alias("parts"))
    each = different.select("r1", "r2", F.inline("parts")).join(settled, ["key", "s1", "s2"])
    verdict = each.groupBy("r1", "r2").agg(F.collect_list(F.struct("offset", "size", "m", "at")).alias("parts"))
    met = runs.select("doc", "t", "start", "r1", "r2").join(scratch.write(verdict), ["r1", "r2"])
    gone = F.filter("parts", lambda p: (F.col("doc") > p["m"]) | p["at"].isNotNull())
    placed = F.transform(
        gone,
        lambda p: F.struct(
            (F.col("start") + p["offset"]).alias("start"),
            p["size"].alias("size"),
            F.when(F.col("doc") == p["m"], p["at"]).alias("at"),
        ),
    )
    cut = met.select("doc", "t", placed.alias("cuts")).where(F.size("cuts") > 0)
    cuts = scratch.write(cut.groupBy("doc", "t").agg(F.flatten(F.collect_list("cuts")).alias("cuts")))
    scratch.keep_only(cuts)
    return cuts


def _met(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` joined with a table of one row per key, where ``c`` is the number of rows
    that have the key. Rows of a common key stay where they are and meet a broadcast of
    the common keys, of which there are at most ``HOT_KEYS``, since together they have no
    more rows than there are; the others are shuffled."""
    limit = max(HOT_ROWS, rows.count() // HOT_KEYS)
    common = F.broadcast(keys.where(F.col("c") > limit).drop("c"))
    others = keys.where(F.col("c") <= limit).drop("c")
    apart = rows.join(common, on, "left_anti").join(others, on, how)
    return rows.join(common, on, how).unionByName(apart)


def _chain(stretches: pa.Array) -> pa.Array:
    """Of the stretches of each text: runs of stretches that follow one another, each with
    its place, a 128-bit name made of the names of its stretches, and these."""
    ends = stretches.offsets.to_numpy()
    flat = stretches.flatten()
    columns = {c: flat.field(c).to_numpy() for c in ("start", "size", "key", "s1", "s2")}
    row = np.repeat(np.arange(len(stretches)), np.diff(ends))
    order = np.lexsort((columns["start"], row))
    row = row[order]
    start, size, *names = (columns[c][order] for c in ("start", "size", "key", "s1", "s2"))
    heads = np.ones(len(row), bool)
    heads[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + size[:-1])
    first = np.append(np.flatnonzero(heads), len(row))
    halves = [size.astype(np.uint64) + np.uint64(k << 32) for k in range(2)]
    for column in names:
        halves = [mix(h * np.uint64(0x9E3779B97F4A7C15) + np.ascontiguousarray(column).view(np.uint64)) for h in halves]
    parts = pa.StructArray.from_arrays(
        [pa.array(c) for c in ((start - np.repeat(start[heads], np.diff(first))).astype(np.int32), size, *names)],
        ["offset", "size", "key", "s1", "s2"],
    )
    runs = pa.StructArray.from_arrays(
        [
            pa.array(start[heads]),
            *(pa.array(signed(Spans(h, SEED + 5 + k)(first[:-1], first[1:]))) for k, h in enumerate(halves)),
            pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), parts),
        ],
        ["start", "r1", "r2", "parts"],
    )
    counts = np.bincount(row[heads], minlength=len(stretches))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), runs)


def _identified(docs: DataFrame) -> DataFrame:
    """Documents by id and hash of the text, so that rows that share an id stay apart."""
    return pick(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"),
        F.xxhash64("text").alias("t"),
        "text",
    )


def _cut(docs: DataFrame, window: int, rounds: int) -> tuple[DataFrame, list[str]]:
    """Enclosed rows with n_words, n_removed and kept."""
    entries = F.expr("16 + 24 * size(cuts) + 4 * aggregate(cuts, 0, (n, c) -> n + greatest(size(c.at), 0))")
    cuts = small_side(repeated(docs, window, rounds), entries)
    rows, names = enclose(docs)
    doc, text = inner(names, "doc_id"), inner(names, "text")
    own = (F.coalesce(doc, F.lit(_LAST)) == F.col("doc")) & (F.xxhash64(text) == F.col("t"))
    joined = rows.join(cuts, own, "left").withColumn("left", _remove(window)(text, "cuts"))
    return joined.select(*rows.columns, "left.n_words", "left.n_removed", "left.kept"), names


def remove_repeated(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with n_words, n_removed and kept (the words left, joined by one space)."""
    rows, names = _cut(docs, window, rounds)
    return disclose(rows, names, "n_words", "n_removed", "kept")


def deduplicate(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` without repeated passages; texts that lose nothing stay as they are,
    documents that lose all words go, and n_chars, where there is one, follows."""
    rows, names = _cut(docs, window, rounds)
    rows = rows.where("n_removed = 0 OR n_removed < n_words")
    lost = F.col("n_removed") > 0
    if "n_chars" in names:
        chars = inner(names, "n_chars")
        size = F.length("kept").cast(rows.schema[chars].dataType)
        rows = rows.withColumn(chars, F.when(lost, size).otherwise(F.col(chars)))
    text = inner(names, "text")
    rows = rows.withColumn(text, F.when(lost, F.col("kept")).otherwise(F.col(text)))
    return disclose(rows, names)
