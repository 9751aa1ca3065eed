"""Packing documents into sequences of at most 2048 tokens.

A document becomes tokens in an Arrow UDF and leaves it as pieces: start, length and
a checksum, not the ids, so what is shuffled is a few numbers per document. Pieces
are dealt by hash into groups of a few thousand; each group is packed by best fit and
then improved by local search: documents move, or are exchanged one for one or two
for one between underfull sequences, always so that the sum of squared fills grows,
until a sequence is empty. A group wastes part of one sequence, so groups of
thousands come within a fraction of a percent of the least number.

The ids are those that ``tokenizers`` gives for the public ``byte_bpe_50k`` vocabulary. One
rule decides how they are computed: a text that holds the special token, which only that
library knows, or a run of ``LONG_BLANK`` or more white-space characters, on which the
pattern of the other one runs out of stack, goes through ``tokenizers``; all others go
through ``tiktoken``, which has the same ranks and is four times as fast. Its pattern is the same
but for the look-ahead, by which the last of several blanks goes with the word after it:
texts are cut there instead, as no token spans such a place, and the pattern without it
takes a third less time.

Defined cases: a null text is an empty one, whose only token is the end token;
repeated rows are packed as often as they occur; a document over the limit is cut so
that only its first piece is shorter than the limit.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
import sys
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import Scratch, pick

CAPACITY = 2048
END = 0
GROUP = 4096
SPECIAL = "<|endoftext|>"
LONG_BLANK = 50_000
TOKENIZER = "byte_bpe_50k"


@functools.cache
def _exact(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))


@functools.cache
def _fast(name: str):
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = public_tokenizers.PATTERN.replace(r"\s+(?!\S)|\s+", r"\s+")
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_BLANKS = re.compile(rf"\s{{{LONG_BLANK}}}")
# White space as the pattern of the vocabulary has it; Python's own has four more characters.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEVERAL = re.compile(f"[{_SPACE}]{{2}}")
_CUT = re.compile(f"(?<=[{_SPACE}])(?=[{_SPACE}][^{_SPACE}])")


def encode(text: str | None, name: str = TOKENIZER) -> array:
    """The ids of a text and the end token, as unsigned 32-bit numbers."""
    text = text or ""
    if SPECIAL in text or (len(text) >= LONG_BLANK and _BLANKS.search(text)):
        ids = _exact(name).encode(text, add_special_tokens=False).ids
    elif _SEVERAL.search(text):
        ids = [i for part in _CUT.split(text) for i in _fast(name).encode_ordinary(part)]
    else:
        ids = _fast(name).encode_ordinary(text)
    ids.append(END)
    return array("I", ids)


def checksum(ids: array) -> int:
    """CRC-32 of ids as little-endian numbers."""
    if sys.byteorder != "little":
        ids = array("I", ids)
        ids.byteswap()
    return zlib.crc32(ids)


def cuts(n: int, capacity: int) -> list[int]:
    """Where the pieces of n tokens start; all but the first are full."""
    first = (n - 1) % capacity + 1
    return [0, *range(first, n, capacity)]


_PIECE = "array<struct<start:bigint,length:bigint,ids_crc32:bigint>>"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32."""

    def cut(texts: pa.Array) -> pa.Array:
        first, starts, lengths, sums = array("i", [0]), array("q"), array("q"), array("q")
        for text in texts.to_pylist():
            ids = encode(text, tokenizer)
            n = len(ids)
            if n <= capacity:
                starts.append(0)
                lengths.append(n)
                sums.append(checksum(ids))
            else:
                own = cuts(n, capacity)
                for start, end in zip(own, [*own[1:], n], strict=True):
                    starts.append(start)
                    lengths.append(end - start)
                    sums.append(checksum(ids[start:end]))
            first.append(len(starts))
        columns = [pa.array(np.frombuffer(c, np.int64)) for c in (starts, lengths, sums)]
        rows = pa.StructArray.from_arrays(columns, ["start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(np.frombuffer(first, np.int32)), rows)

    found = pick(docs, "doc_id", "text").select("doc_id", arrow_udf(cut, _PIECE)("text").alias("_pieces"))
    return found.select("doc_id", F.posexplode("_pieces").alias("piece", "_p")).select(
        "doc_id", "piece", "_p.start", "_p.length", "_p.ids_crc32"
    )


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each bin: the longest first, each into the fullest bin
    that has room."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(rooms, (lengths[i], -1))
        if at == len(rooms):
            room, bin_ = capacity, len(bins)
            bins.append([])
        else:
            room, bin_ = rooms.pop(at)
        bins[bin_].append(i)
        if room > lengths[i]:
            bisect.insort(rooms, (room - lengths[i], bin_))
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empties bins by exchanges that raise the sum of squared fills.

    The emptiest bin gives: it moves a document to another underfull bin, or exchanges
    one or two of its documents for a shorter one there. Each such step raises the
    squared fill, so the search ends; a bin that no step empties stays as it is.
    """
    least = -(-sum(lengths) // capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    stuck: set[int] = set()
    alive = {b for b, f in enumerate(fill) if f}
    while len(alive) > least:
        open_ = [b for b in alive if fill[b] < capacity]
        giver = min((b for b in open_ if b not in stuck), key=lambda b: (fill[b], b), default=None)
        if giver is None:
            break
        step = _best_step(giver, open_, bins, fill, lengths, capacity)
        if step is None:
            stuck.add(giver)
            continue
        gives, taker, takes = step
        for i in gives:
            bins[giver].remove(i)
        bins[taker] += gives
        if takes is not None:
            bins[taker].remove(takes)
            bins[giver].append(takes)
        moved = sum(lengths[i] for i in gives) - (lengths[takes] if takes is not None else 0)
        fill[giver] -= moved
        fill[taker] += moved
        stuck.discard(taker)
        if not fill[giver]:
            alive.discard(giver)
            stuck.clear()
    return [b for b in bins if b]


def _best_step(giver, open_, bins, fill, lengths, capacity):
    """The step from ``giver`` that fills another bin the most: (numbers given, bin,
    number taken back or None)."""
    own = bins[giver]
    gifts = [([i], lengths[i]) for i in own]
    gifts += [([i, j], lengths[i] + lengths[j]) for k, i in enumerate(own) for j in own[:k]]
    sizes = np.array([n for _, n in gifts])
    takers = [b for b in open_ if b != giver and fill[b] >= fill[giver]]
    if not takers:
        return None
    back = [(b, None, 0) for b in takers] + [(b, i, lengths[i]) for b in takers for i in bins[b]]
    room = np.array([capacity - fill[b] for b, _, _ in back])
    returned = np.array([n for _, _, n in back])
    best = None
    for g in np.unique(sizes, return_index=True)[1]:
        gain = sizes[g] - returned
        gain = np.where((gain > 0) & (gain <= room), gain, 0)
        at = int(np.argmax(gain))
        if gain[at] and (best is None or gain[at] > best[0]):
            best = int(gain[at]), gifts[g][0], back[at][0], back[at][1]
    return best and best[1:]


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, group: int = GROUP
) -> DataFrame:
    """Where each piece goes: pieces() with sequence_id and offset."""
    numbered = pieces(docs, capacity, tokenizer).withColumn("_row", F.monotonically_increasing_id())
    cut = Scratch(docs.sparkSession, "pieces").write(numbered)
    groups = max(1, -(-cut.count() // group))

    def packed(rows: pa.Table) -> pa.Table:
        numbers = {n: rows[n].to_numpy() for n in ("length", "piece", "_row", "_group")}
        order = np.lexsort((numbers["piece"], numbers["_row"], -numbers["length"]))
        lengths = numbers["length"][order].tolist()
        sequence = np.zeros(len(order), np.int64)
        offset = np.zeros(len(order), np.int64)
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        for number, members in enumerate(bins):
            at = 0
            for i in members:
                sequence[order[i]], offset[order[i]] = number, at
                at += lengths[i]
        sequence += numbers["_group"] << 32
        placed = rows.append_column("sequence_id", pa.array(sequence))
        return placed.append_column("offset", pa.array(offset)).select(names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("_row", "piece"), F.lit(groups).cast("long")))
    schema = cut.drop("_row").schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_group").applyInArrow(packed, schema)


def token_sequences(
    docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER
) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids. ``doc_id`` must be unique."""

    def ids_of(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            ids = encode(text.as_py(), tokenizer)
            starts = cuts(len(ids), capacity)
            rows.append([ids[a:b].tolist() for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)])
        return pa.array(rows, pa.list_(pa.list_(pa.int64())))

    ids = arrow_udf(ids_of, "array<array<bigint>>")("text")
    texts = pick(docs, "doc_id", "text").select("doc_id", ids.alias("_ids"))
    texts = texts.select("doc_id", F.posexplode("_ids").alias("piece", "ids"))
    return (
        placed.join(texts, ["doc_id", "piece"])
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
        .select("sequence_id", F.flatten("_parts.ids").alias("ids"))
    )
