"""Benchmark decontamination with a generalised suffix automaton.

The items become token sequences and one automaton of all their substrings. A
document streams its tokens through it and always knows the longest suffix that is
a substring of some item. Words are named by 64-bit hashes, so only runs of words
that the items have at all reach the automaton.

The automaton is broadcast. Items are dealt into blocks of at most ``block_chars``
characters, one automaton each, and documents pass the blocks one after the other,
with a checkpoint between them; so what is broadcast never grows with the items.

Defined cases: a null or empty text has no words; an item without words or without
an id takes no part; repeated items and repeated rows each count as they stand,
an item id once per document; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import Scratch, disclose, enclose, inner, pick
from docstrata.llm.words import Hasher, Words, alphanumeric, buffers, chunks

WINDOW = 13
COVERAGE = 20
BLOCK_CHARS = 1 << 20
SEED = 0x0BEC

_FOUND = "struct<n_words:bigint,spans:array<struct<first:bigint,last:bigint>>,items:array<string>>"
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


class Automaton:
    """All substrings of token sequences; states are lists indexed by number."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, nexts: dict[int, int], link: int) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """The part of ``target`` that is reached with one token from ``state`` on."""
        part = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = part
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = part
            state = self.link[state]
        return part

    def extend(self, last: int, token: int) -> int:
        """The state after one more token of the sequence that ends in ``last``."""
        target = self.next[last].get(token)
        if target is not None:
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, token, target)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, token, target)
            self.link[new] = target
        return new


class Matcher:
    """The automaton of a block of items, with what is needed to report them."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        hasher = Hasher(alphanumeric(), SEED, fold=True)
        hashes = _hashes(pa.array([text for _, text in items], pa.string()), hasher)
        known = [h for h in hashes if len(h)]
        self.vocabulary = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.window = window
        sequences = [
            (item, np.searchsorted(self.vocabulary, h).tolist())
            for (item, _), h in zip(items, hashes, strict=True)
            if len(h)
        ]
        self.shortest = min((min(window, len(s)) for _, s in sequences), default=window)
        self.automaton = a = Automaton()
        for _, tokens in sequences:
            last = 0
            for token in tokens:
                last = a.extend(last, token)
        self.window_state = self._window_states()
        self.window_items: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, tokens in sequences:
            state = 0
            for i, token in enumerate(tokens):
                state = a.next[state][token]
                if i + 1 >= window:
                    named = self.window_items.setdefault(self.window_state[state], set())
                    named |= {item} - {None}
            if len(tokens) < window:
                self.short.setdefault(state, []).append((len(tokens), item))
        self.short_above = self._short_above()

    def _by_length(self) -> list[int]:
        return sorted(range(len(self.automaton.length)), key=self.automaton.length.__getitem__)

    def _window_states(self) -> list[int]:
        """For each state the one that holds its suffix of one window, or -1."""
        a, out = self.automaton, [-1] * len(self.automaton.length)
        for s in self._by_length():
            if a.length[s] >= self.window:
                out[s] = out[a.link[s]] if a.length[a.link[s]] >= self.window else s
        return out

    def _short_above(self) -> list[int]:
        """For each state the nearest one, itself included, where a short item ends."""
        a, out = self.automaton, [-1] * len(self.automaton.length)
        for s in self._by_length():
            out[s] = s if s in self.short else out[a.link[s]] if a.link[s] >= 0 else -1
        return out

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words that the items have, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def match(self, tokens: list[int], base: int, spans: list[list[int]], items: set[str]) -> None:
        """Adds the spans and items found in a run of known words that starts at ``base``."""
        a, state, length = self.automaton, 0, 0
        for i, token in enumerate(tokens):
            while state and token not in a.next[state]:
                state = a.link[state]
                length = a.length[state]
            if token in a.next[state]:
                state = a.next[state][token]
                length += 1
            covered = 0
            if length >= self.window:
                covered = length
                items |= self.window_items[self.window_state[state]]
            end = self.short_above[state]
            while end >= 0:
                for size, item in self.short[end]:
                    if size <= length:
                        items |= {item} - {None}
                        covered = max(covered, size)
                above = a.link[end]
                end = self.short_above[above] if above >= 0 else -1
            if covered:
                add_span(spans, base + i + 1 - covered, base + i + 1)


def add_span(spans: list[list[int]], first: int, last: int) -> None:
    """Keeps spans sorted and apart; ``last`` never falls from call to call."""
    while spans and spans[-1][1] >= first:
        first = min(first, spans.pop()[0])
    spans.append([first, last])


def _hashes(texts: pa.Array, hasher: Hasher) -> list[np.ndarray]:
    """The hashed words of each text."""
    data, offsets = buffers(texts)
    out: list[np.ndarray] = []
    for low, high in chunks(offsets):
        words = Words(
            data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], hasher.table != 0
        )
        hashes = words.hashes(hasher)
        out += [hashes[words.first[d] : words.first[d + 1]] for d in range(high - low)]
    return out


def _runs(tokens: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Where at least ``least`` known words follow one another."""
    known = np.concatenate([[False], tokens >= 0, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[::2], edges[1::2]
    keep = ends - starts >= least
    return list(zip(starts[keep].tolist(), ends[keep].tolist(), strict=True))


def finder(matcher) -> Callable[[Column], Column]:
    """The column function that reports what a text shares with a broadcast matcher."""

    def found(texts: pa.Array) -> pa.Array:
        known = matcher.value
        hasher = Hasher(alphanumeric(), SEED, fold=True)
        rows = []
        for hashes in _hashes(texts, hasher):
            spans: list[list[int]] = []
            items: set[str] = set()
            tokens = known.tokens(hashes)
            for start, end in _runs(tokens, known.shortest):
                known.match(tokens[start:end].tolist(), start, spans, items)
            rows.append(
                {
                    "n_words": len(hashes),
                    "spans": [{"first": s, "last": e} for s, e in spans],
                    "items": sorted(items),
                }
            )
        return pa.array(rows, _FOUND_ARROW)

    return arrow_udf(found, _FOUND)


def _merged(one: pa.Array, two: pa.Array) -> pa.Array:
    rows = []
    for a, b in zip(one.to_pylist(), two.to_pylist(), strict=True):
        spans: list[list[int]] = []
        for s in sorted([*a, *b], key=lambda s: (s["last"], s["first"])):
            add_span(spans, s["first"], s["last"])
        rows.append([{"first": s, "last": e} for s, e in spans])
    return pa.array(rows, _FOUND_ARROW.field("spans").type)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``docs`` with the columns n_words, spans (of word numbers, last excluded) and
    items (the ids of the items with an occurring window, as sorted strings)."""
    rows, names = enclose(docs)
    found = _contamination(rows, inner(names, "text"), items, window, block_chars)
    return disclose(found, names, "n_words", "spans", "items")


def _contamination(
    rows: DataFrame, text: str, items: DataFrame, window: int, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    spark = rows.sparkSession
    known = pick(items, "item_id", "text").where("text IS NOT NULL")
    known = known.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    chars = known.agg(F.sum(F.length("text"))).first()[0] or 0
    merged = arrow_udf(_merged, "array<struct<first:bigint,last:bigint>>")
    blocks = max(1, -(-2 * chars // block_chars)) if chars > block_chars else 1
    scratch = Scratch(spark, "contamination")
    own, out = rows.columns, rows
    for block in range(blocks):
        dealt = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        matcher = spark.sparkContext.broadcast(
            Matcher(sorted(((r["item_id"], r["text"]) for r in dealt), key=lambda i: (i[0] is None, *map(str, i))), window)
        )
        found = out.withColumn("found", finder(matcher)(text))
        if not block:
            out = found.select(*own, "found.n_words", "found.spans", "found.items")
            continue
        out = scratch.write(
            found.withColumns(
                {
                    "spans": merged("spans", "found.spans"),
                    "items": F.array_sort(F.array_union("items", "found.items")),
                }
            ).drop("found")
        )
    return out


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def is_contaminated(coverage: int = COVERAGE) -> Column:
    """Any hit, and at least one word in ``coverage`` hit."""
    return (hit_words() > 0) & (hit_words() * coverage >= F.col("n_words"))


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the bytes of the words of some spans and what is between them."""
    out = []
    hasher = alphanumeric()
    for text, cut in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        if text is None or not cut:
            out.append(text)
            continue
        data = text.encode()
        words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), hasher)
        kept, at = [], 0
        for s in cut:
            kept.append(data[at : words.starts[s["first"]]])
            at = words.ends[s["last"] - 1]
        out.append(b"".join([*kept, data[at:]]).decode())
    return pa.array(out, pa.string())


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: int = COVERAGE,
    longest_span: int | None = None,
) -> DataFrame:
    """``docs`` without those the items cover by 1 / ``coverage`` or more; from the
    rest, spans of more than ``longest_span`` words are cut out (None: left alone)."""
    rows, names = enclose(docs)
    text = inner(names, "text")
    found = _contamination(rows, text, items, window).where(~is_contaminated(coverage))
    if longest_span is not None:
        long = F.filter("spans", lambda s: s["last"] - s["first"] > longest_span)
        found = found.withColumn(text, arrow_udf(_without, "string")(text, long))
    return disclose(found, names)
