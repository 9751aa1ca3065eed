"""Near-duplicates: MinHash signatures and a multi-index Hamming join.

A document is the set of its distinct word shingles. Documents with equal sets are one
class from the start. A class has a signature of ``chunks * slots`` b-bit MinHash
values. Two signatures that differ in at most ``chunks * (errors + 1) - 1`` slots agree,
by pigeonhole, in some chunk up to ``errors`` slots; so every chunk is entered in the
index once for each choice of ``errors`` slots left out, and all pairs under that
distance share an entry. Sets that are 80 % alike differ in 10 of the default 50 slots
on average and share an entry with a probability of 0.999998.

The entries of the index are worked off in two steps. First the smallest member of each
entry meets the others; pairs that pass the signature distance make families. The sets
of a family of bounded size are brought together once, where all of them meet; in larger
families the pairs are confirmed on the full sets, at one comparison per member, also for
thousands of near copies. Components grow. In entries that still hold several families or,
of large ones, components, every member outside the largest one meets all others on full
sets, in blocks of bounded size that emit links instead of pairs. So no pair of different
components is left out.

Defined cases: a text without words, or null, has no shingles and is linked with
nothing; a text with fewer words than a shingle has its whole sequence as the only
one; rows that share a doc_id are one document, linked where any of its texts is,
so its classes are linked from the start and all its rows have one component; a row
without doc_id gets the component of its class, if there is one, and links nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import Scratch, disclose, enclose, inner, pick, small_side
from docstrata.llm.words import Hasher, Spans, Words, buffers, chunks, mix, not_space, signed, stream

WORDS = 5
PERCENT = 80
CHUNKS = 10
SLOTS = 5
ERRORS = 1
BITS = 16
SEED = 0x5E75
#: Signatures further apart than this belong to sets less than half alike.
DISTANCE = 26

# Elements of the sets that one block of an entry holds: of those asking, of all.
_FEW_ELEMENTS = 1 << 18
_MANY_ELEMENTS = 1 << 20
# Elements of the sets of a family that meet all at once.
_FAMILY_ELEMENTS = 1 << 20
# What a signature counts for, in elements.
_SIGNATURE = 100

_MARK = "struct<n:bigint,f1:bigint,f2:bigint,sig:binary>"


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hasher = Hasher(not_space(), SEED, fold=True)
    data, offsets = buffers(texts)
    for low, high in chunks(offsets):
        words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], not_space())
        spans = Spans(words.hashes(hasher), SEED)
        counts = np.diff(words.first)
        starts = np.arange(len(words))
        ends = np.minimum(starts + size, np.repeat(words.first[1:], counts))
        grams = spans(starts, ends)
        for first, count in zip(words.first[:-1].tolist(), counts.tolist(), strict=True):
            yield np.unique(grams[first : first + max(count - size + 1, min(count, 1))])


def signatures(sets: list[np.ndarray], slots: int, bits: int = BITS) -> np.ndarray:
    """A row of b-bit minima for each set that is not empty."""
    sizes = np.array([len(s) for s in sets])
    joined = np.concatenate(sets)
    firsts = np.cumsum(sizes) - sizes
    factors, terms = stream(SEED + 1, slots) | np.uint64(1), stream(SEED + 2, slots)
    out = np.empty((len(sets), slots), "<u2")
    for k in range(slots):
        # The least of many hashes is small: scattered, its upper bits say as much as any.
        least = mix(np.minimum.reduceat(joined * factors[k] + terms[k], firsts))
        out[:, k] = least >> np.uint64(64 - bits)
    return out


def _marks(size: int, slots: int):
    def marks(texts: pa.Array) -> pa.Array:
        n, one, two, sigs = [], [], [], []
        for group in _groups(shingle_sets(texts, size)):
            full = [s for s in group if len(s)]
            rows = iter(signatures(full, slots)) if full else iter(())
            for s in group:
                n.append(len(s))
                one.append(int(signed(mix(s)).sum()) if len(s) else 0)
                two.append(int(signed(mix(s ^ np.uint64(SEED))).sum()) if len(s) else 0)
                sigs.append(next(rows).tobytes() if len(s) else None)
        columns = [pa.array(c, pa.int64()) for c in (n, one, two)] + [pa.array(sigs, pa.binary())]
        return pa.StructArray.from_arrays(columns, ["n", "f1", "f2", "sig"])

    return arrow_udf(marks, _MARK)


def _groups(sets: Iterator[np.ndarray], limit: int = 1 << 18) -> Iterator[list[np.ndarray]]:
    """Sets in groups of about ``limit`` elements."""
    group: list[np.ndarray] = []
    size = 0
    for s in sets:
        group.append(s)
        size += len(s) + 1
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def _index(chunk_count: int, slots: int, errors: int):
    """Rows (node, sig) to one row (node, key) per chunk and choice of slots."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch["node"]
            joined = b"".join(batch["sig"].to_pylist())
            sigs = np.frombuffer(joined, "<u2").reshape(len(nodes), -1).astype(np.uint64)
            number = 0
            for chunk in range(chunk_count):
                for kept in itertools.combinations(range(slots), slots - errors):
                    number += 1
                    key = np.full(len(nodes), number, np.uint64)
                    for slot in kept:
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sigs[:, chunk * slots + slot])
                    yield pa.RecordBatch.from_arrays([nodes, pa.array(signed(key))], ["node", "key"])

    return entries


def _distance(one: pa.Array, two: pa.Array) -> pa.Array:
    if not len(one):
        return pa.array([], pa.int32())
    a, b = (np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(len(x), -1) for x in (one, two))
    return pa.array((a != b).sum(axis=1), pa.int32())


def _set_arrays(size: int):
    def arrays(texts: pa.Array) -> pa.Array:
        sets = list(shingle_sets(texts, size))
        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return arrow_udf(arrays, "array<bigint>")


def _alike(percent: int) -> Column:
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return shared * 100 >= union * percent


def merge_labels(scratch: Scratch, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after links (a, b) between labels are contracted.

    Every label hangs below its smallest neighbour, chains are shortened by doubling,
    and the links are renamed, until none joins two labels.
    """
    links = scratch.write(_ordered_links(links))
    while not links.isEmpty():
        parents = scratch.write(links.groupBy("b").agg(F.min("a").alias("p")))
        while True:
            above = parents.select(F.col("b").alias("p"), F.col("p").alias("pp"))
            longer = scratch.write(
                parents.join(above, "p", "left").select(
                    "b", F.coalesce("pp", "p").alias("p"), F.isnotnull("pp").alias("moved")
                )
            )
            done = longer.where("moved").isEmpty()
            parents = longer.select("b", "p")
            if done:
                break
        labels = labels.join(parents.withColumnRenamed("b", "label"), "label", "left")
        labels = scratch.write(labels.select("node", F.coalesce("p", "label").alias("label")))
        for end in ("a", "b"):
            to = parents.withColumnRenamed("b", end)
            links = links.join(to, end, "left").withColumn(end, F.coalesce("p", end)).drop("p")
        links = scratch.write(_ordered_links(links))
    return labels


def _ordered_links(links: DataFrame) -> DataFrame:
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.where("a < b").distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    chunk_count: int = CHUNKS,
    slots: int = SLOTS,
    errors: int = ERRORS,
    distance: int = DISTANCE,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    scratch = Scratch(docs.sparkSession, "near")
    texts = pick(docs, "doc_id", "text")
    mark = _marks(words, chunk_count * slots)("text").alias("_m")
    marks = scratch.write(texts.select("doc_id", F.xxhash64("text").alias("h"), mark).select("doc_id", "h", "_m.*"))
    own = marks.where("n > 0 AND doc_id IS NOT NULL")
    classes = own.groupBy("n", "f1", "f2").agg(
        F.min(F.struct("doc_id", "h")).alias("least"), F.first("sig").alias("sig")
    )
    classes = scratch.write(
        classes.select("n", "f1", "f2", "least.*", "sig", F.monotonically_increasing_id().alias("node"))
    )
    owned = _owned(scratch, marks, classes)
    entries = classes.select("node", "sig").mapInArrow(
        _index(chunk_count, slots, errors), "node bigint, key bigint"
    )
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    members = scratch.write(entries.join(shared, "key").select("key", "node"))
    nodes = scratch.write(members.select("node").distinct())
    sets = scratch.write(_sets_of(texts, classes.join(nodes, "node", "left_semi"), words))
    grouped = scratch.write(nodes.unionByName(owned.select("node")).distinct())
    sigs = scratch.write(classes.join(nodes, "node", "left_semi").select("node", "n", "sig"))
    labels = scratch.write(grouped.select("node", F.col("node").alias("label")))
    firsts = scratch.write(owned.groupBy("doc_id").agg(F.min("node").alias("a")))
    same = owned.join(firsts, "doc_id").select("a", F.col("node").alias("b"))
    members = _open_entries(scratch, members, labels)
    heads = scratch.write(members.groupBy("key").agg(F.min("node").alias("head")))
    found = members.join(small_side(heads, 16), "key").where("node <> head")
    pairs = found.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    pairs = scratch.write(_close(pairs, sigs, percent, distance))
    families = _families(scratch, merge_labels(scratch, labels, pairs), sigs)
    met = small_side(families, 16)
    large = pairs.join(met.select(F.col("node").alias("a")), "a", "left_anti")
    alike = _within_families(met, sets, percent).unionByName(_confirmed(scratch.write(large), sets, percent))
    labels = merge_labels(scratch, labels, alike.unionByName(same))
    rest = members.join(small_side(heads, 16), "key").where("node <> head").select("key", "node")
    # Pairs of one family have met, so entries are open between families; -1, -2, ... are no labels.
    apart = labels.join(met, "node", "left")
    apart = apart.select("node", F.coalesce(-1 - F.col("family"), "label").alias("label"), F.col("label").alias("own"))
    rest = _open_entries(scratch, rest, scratch.write(apart))
    links = scratch.write(_within_entries(scratch, rest, sigs, sets, percent, distance))
    labels = merge_labels(scratch, labels, links)
    merged = labels.join(classes.select("node", "doc_id"), "node")
    least = scratch.write(merged.groupBy("label").agg(F.min("doc_id").alias("component_id")))
    merged = scratch.write(labels.join(least, "label").select("node", "component_id"))
    of_class = scratch.write(
        classes.join(merged, "node", "left").select(
            "n", "f1", "f2", F.coalesce("component_id", "doc_id").alias("of_class")
        )
    )
    of_doc = firsts.join(merged.withColumnRenamed("node", "a"), "a")
    of_doc = scratch.write(of_doc.select("doc_id", F.col("component_id").alias("of_doc")))
    scratch.keep_only(marks, of_class, of_doc)
    component = F.coalesce("of_doc", "of_class", "doc_id")
    found = marks.join(of_class, ["n", "f1", "f2"], "left").join(of_doc, "doc_id", "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _owned(scratch: Scratch, marks: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (doc_id, node) of the documents whose rows are not all of one class."""
    parts = ("n", "f1", "f2")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in parts for f in (F.min, F.max)]
    apart = marks.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*ends)
    apart = scratch.write(apart.where(" OR ".join(f"min_{c} < max_{c}" for c in parts)).select("doc_id"))
    rows = marks.where("n > 0").join(apart, "doc_id").select("doc_id", *parts).distinct()
    return scratch.write(rows.join(classes.select(*parts, "node"), list(parts)).select("doc_id", "node"))


def _open_entries(scratch: Scratch, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of entries that hold several labels: key and the columns of ``labels``."""
    labelled = members.select("key", "node").join(labels, "node").select("key", *labels.columns)
    apart = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    apart = small_side(scratch.write(apart.where("lo < hi").select("key")), 8)
    return scratch.write(labelled.join(apart, "key"))


def _families(scratch: Scratch, labels: DataFrame, sigs: DataFrame) -> DataFrame:
    """Rows (node, family) of the labels of several nodes that are small enough for all of
    their sets to meet at once, with the elements ``n`` of the node."""
    sized = scratch.write(labels.join(sigs.select("node", "n"), "node"))
    held = sized.groupBy("label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("all"))
    held = held.where((F.col("c") > 1) & (F.greatest("all", F.col("c") * _SIGNATURE) <= _FAMILY_ELEMENTS))
    held = small_side(scratch.write(held.select("label")), 8)
    return scratch.write(sized.join(held, "label").select("node", F.col("label").alias("family"), "n"))


def _within_families(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links (a, b) within families. A group holds several families, about as many as a
    block does."""
    elements = families.agg(F.sum("n")).first()[0] or 0
    group = F.pmod(F.xxhash64("family"), F.lit(elements // _FEW_ELEMENTS + 1)).alias("group")
    rows = sets.join(families, "node").select(group, F.col("node").alias("own"), "set")
    return rows.groupBy("group").applyInArrow(_links_of(percent), "a bigint, b bigint")


def _within_entries(
    scratch: Scratch,
    members: DataFrame,
    sigs: DataFrame,
    sets: DataFrame,
    percent: int,
    distance: int,
) -> DataFrame:
    """Links (a, b) between the components (``own``) of members of an entry with different
    labels.

    In each entry one label has the most members; every pair to compare has a member
    of another label. Those meet all members in blocks of bounded size, an exact join on
    an inverted index of the block, which emits links and no pairs.  The blocks meet twice:
    first with the signatures, a hundred bytes each, which leaves the members that have one
    of another label within ``distance``; then with the full sets of those.
    """
    sized = scratch.write(members.join(sigs.select("node", "n"), "node"))
    held = sized.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    entry = held.groupBy("key").agg(
        F.max(F.struct("c", "label", "n")).alias("big"), F.sum("n").alias("n"), F.sum("c").alias("c")
    )
    entry = entry.select(
        "key",
        F.col("big.label").alias("big"),
        _blocks(F.col("n") - F.col("big.n"), F.col("c") - F.col("big.c"), _FEW_ELEMENTS).alias("others"),
        _blocks(F.col("n"), F.col("c"), _MANY_ELEMENTS).alias("blocks"),
    )
    placed = sized.join(small_side(scratch.write(entry), 32), "key")

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(count).cast("long")).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    other = placed.where("label <> big").select(
        "key", "node", "label", "own", F.lit(True).alias("asks"), block("others").alias("o"), every("blocks").alias("m")
    )
    known = placed.select(
        "key", "node", "label", "own", F.lit(False).alias("asks"), block("blocks").alias("m"), every("others").alias("o")
    )
    rows = scratch.write(other.unionByName(known))
    signed_rows = rows.join(sigs.select("node", "sig"), "node").groupBy("key", "o", "m")
    near = scratch.write(signed_rows.applyInArrow(_near_of(distance), rows.schema))
    blocks = near.join(sets, "node").groupBy("key", "o", "m")
    return blocks.applyInArrow(_links_of(percent), "a bigint, b bigint")


def _blocks(elements: Column, members: Column, most: int) -> Column:
    """How many blocks hold sets of so many elements, and their members' signatures."""
    return F.ceil(F.greatest(elements, members * _SIGNATURE) / most).cast("int")


def _near_of(distance: int):
    """Of a block of rows (asks, label, sig): those that ask and have a known one of
    another label within the distance, and those known ones."""

    def near(rows: pa.Table) -> pa.Table:
        label = rows["label"].to_numpy()
        asks = rows["asks"].to_numpy(zero_copy_only=False).astype(bool)
        sigs = np.frombuffer(b"".join(rows["sig"].to_pylist()), "<u2").reshape(len(label), -1)
        # The members by slot and value, as an inverted index.
        slots = sigs.shape[1]
        values = sigs + (np.arange(slots, dtype=np.int32) << 16)
        known = np.flatnonzero(~asks).astype(np.int32)
        owner = np.repeat(known, slots)
        listed = values[known].ravel()
        order = np.argsort(listed, kind="stable")
        listed, owner = listed[order], owner[order]
        kept = np.zeros(len(label), bool)
        for row in np.flatnonzero(asks).tolist():
            low = np.searchsorted(listed, values[row], "left")
            count = np.searchsorted(listed, values[row], "right") - low
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            same = np.bincount(owner[at], minlength=len(label))
            close = (same >= slots - distance) & ~asks & (label != label[row])
            if close.any():
                kept[row] = True
                kept |= close
        return rows.filter(pa.array(kept)).select(names)

    names = ["key", "node", "label", "own", "asks", "o", "m"]
    return near


def _links_of(percent: int):
    """Of a block of rows (asks, own, set): a link for each two components that join.
    Without ``asks`` every row asks and is known."""

    def links(rows: pa.Table) -> pa.Table:
        label = rows["own"].to_numpy()
        all_meet = "asks" not in rows.column_names
        asks = np.ones(len(label), bool) if all_meet else rows["asks"].to_numpy(zero_copy_only=False).astype(bool)
        lists = rows["set"].combine_chunks()
        values, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        size = np.diff(offsets)
        is_known = asks if all_meet else ~asks
        known = np.flatnonzero(is_known)
        owner = np.repeat(np.arange(len(size)), size)
        listed = is_known[owner]
        order = np.argsort(values[listed], kind="stable")
        sorted_values, owners = values[listed][order], owner[listed][order]
        root = {x: x for x in label.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out: list[tuple[int, int]] = []
        for row in np.flatnonzero(asks).tolist():
            own = values[offsets[row] : offsets[row + 1]]
            low = np.searchsorted(sorted_values, own, "left")
            count = np.searchsorted(sorted_values, own, "right") - low
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared = np.bincount(owners[at], minlength=len(size))[known]
            alike = shared * 100 >= (size[row] + size[known] - shared) * percent
            for other in np.unique(label[known[alike]]).tolist():
                one, two = find(int(label[row])), find(other)
                if one != two:
                    root[max(one, two)] = min(one, two)
                    out.append((int(label[row]), other))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return links


def _sets_of(texts: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """The shingle set of each of some classes, from one of its texts; repeated rows are
    folded first."""
    wanted = small_side(classes.select("doc_id", "h", "node"), 24)
    own = texts.withColumn("h", F.xxhash64("text")).join(wanted, ["doc_id", "h"])
    own = own.groupBy("doc_id", "h", "node").agg(F.first("text").alias("text"))
    return own.select("node", _set_arrays(words)("text").alias("set"))


def _close(pairs: DataFrame, sigs: DataFrame, percent: int, distance: int) -> DataFrame:
    """Pairs whose sizes and signatures allow the similarity."""
    for end in ("a", "b"):
        own = (F.col(c).alias(f"{c}_{end}") for c in ("n", "sig"))
        pairs = pairs.join(sigs.select(F.col("node").alias(end), *own), end)
    sized = pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    apart = arrow_udf(_distance, "int")("sig_a", "sig_b")
    return sized.where(apart <= distance).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are alike. Sets meet under the key of their pair, so one
    that is in many pairs does not make a large partition."""
    one, two = (
        pairs.join(sets.select(F.col("node").alias(end), F.col("set").alias(f"set_{end}")), end)
        for end in ("a", "b")
    )
    return one.join(two, ["a", "b"]).where(_alike(percent)).select("a", "b").distinct()


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are not the first of their component."""
    found = near_duplicates(docs, words, percent)
    gone = Scratch(docs.sparkSession, "copies").write(found.where(~F.col("kept")).select("doc_id").distinct())
    rows, names = enclose(docs)
    doc = inner(names, "doc_id")
    gone = small_side(gone.withColumnRenamed("doc_id", doc), 8)
    return disclose(rows.join(gone, doc, "left_anti"), names)
