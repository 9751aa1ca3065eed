"""Operators against plain Python, and the cases that every one has to define."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docstrata.llm import (
    chat,
    decontaminate,
    licences,
    neardup,
    packing,
    quality,
    queries,
    sharding,
    substrings,
    topk,
    warc,
)
from docstrata.llm.tables import reachable

CLASHING = "key string, node string, n_words string, spans string, kept string, SCORE string, slot string, TEXT string"
CLASHES = ("x",) * 8
LONG = "lorem ipsum dolor " * 60_000
EDGES = [(1, None), (2, ""), (3, "one"), (4, "One"), (5, " \n\t "), (6, LONG), (7, LONG), (7, LONG), (None, "a b c")]


@pytest.fixture(scope="module")
def docs(spark):
    reachable(spark)

    def make(rows, parts=3):
        schema = f"doc_id bigint, text string, {CLASHING}"
        return spark.createDataFrame([(*r, *CLASHES) for r in rows], schema).repartition(parts)

    return make


@pytest.fixture(scope="module")
def items(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, found string")

    return make


def ranks(rows):
    return sorted(rows, key=repr)


# --- quality -----------------------------------------------------------------


@given(st.lists(st.integers(1, 5), min_size=1, max_size=4), st.randoms(use_true_random=False))
@settings(max_examples=30, deadline=None)
def test_marginals_are_those_of_all_labellings(sizes, rng):
    model = quality.Model(
        np.zeros(1),
        np.array([[rng.uniform(-3, 3) for _ in "ab"] for _ in "ab"]),
        np.array([rng.uniform(-2, 2) for _ in "ab"]),
        np.zeros(1),
        np.ones(1),
    )
    evidence = np.array([rng.uniform(-5, 5) for _ in range(sum(sizes))])
    first = np.concatenate([[0], np.cumsum(sizes)])
    p, pair = quality.marginals(model, evidence, first)
    for a, b in itertools.pairwise(first.tolist()):
        total, good, pairs = 0.0, np.zeros(b - a), np.zeros((b - a, 4))
        for labels in itertools.product((0, 1), repeat=b - a):
            score = model.opening[labels[0]] + sum(e for e, y in zip(evidence[a:b], labels, strict=True) if y)
            score += sum(model.pairs[x, y] for x, y in itertools.pairwise(labels))
            weight = np.exp(score)
            total += weight
            good += weight * np.array(labels)
            for i, (x, y) in enumerate(itertools.pairwise(labels)):
                pairs[i, 2 * x + y] += weight
        assert np.allclose(p[a:b], good / total)
        assert np.allclose(pair[a : b - 1], pairs[:-1] / total)


def test_quality_on_held_out_documents(spark):
    reachable(spark)
    root = "/root/testdata/sf0.1"
    texts = spark.read.parquet(f"{root}/documents.parquet")
    labels = spark.read.parquet(f"{root}/labels.parquet")
    model = quality.train(texts, labels.where(~quality.held_out()))
    found = quality.score_documents(texts, model).join(labels.where(quality.held_out()), "doc_id")
    right, rejected, wrong = found.agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("double")),
        F.sum(((F.col("quality") == 0) & (F.col("predicted") == 0)).cast("int")) / F.sum(1 - F.col("quality")),
        F.sum(((F.col("quality") == 1) & (F.col("predicted") == 0)).cast("int")) / F.sum(F.col("quality")),
    ).first()
    assert right > 0.98 and rejected > 0.95 and wrong < 0.02


def test_quality_edges(spark, docs):
    rows = EDGES + [(10 + i, "GOOD!! " * 5 if i % 2 else "some fine words here") for i in range(20)]
    labels = spark.createDataFrame(
        [(10 + i, i % 2, "x") for i in range(20)] + [(10, 1, "x"), (None, 1, "x"), (3, None, "x")],
        "doc_id bigint, quality int, text string",
    )
    model = quality.train(docs(rows), labels)
    found = quality.score_documents(docs(rows), model)
    assert found.columns.count("score") == 1 and "TEXT" in found.columns
    got = found.select("doc_id", "score", "predicted").collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1] == by[2]
    assert by[11] > 0.5 > by[12]
    untrained = quality.train(docs(rows), labels.limit(0))
    assert {r[0] for r in quality.score_documents(docs(rows), untrained).select("score").collect()} == {0.5}
    assert quality.score_documents(docs([]), model).count() == 0
    assert quality.accepted(docs(rows), model).columns == docs([]).columns


# --- decontamination ---------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contaminated(rows, listed, window):
    out = []
    for doc, text in rows:
        words = WORD.findall(lowered(text))
        hit, found = set(), set()
        for item, other in listed:
            tokens = WORD.findall(lowered(other))
            if not tokens:
                continue
            n = min(window, len(tokens))
            for i in range(len(tokens) - n + 1):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == tokens[i : i + n]:
                        hit |= set(range(j, j + n))
                        found |= {str(item)} - {"None"}
        out.append((doc, len(words), sorted(hit), sorted(found)))
    return ranks(out)


def reported(df):
    return ranks(
        (r["doc_id"], r["n_words"], [w for s in r["spans"] for w in range(s["first"], s["last"])], r["items"])
        for r in df.collect()
    )


def test_contamination_is_that_of_brute_force(docs, items):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abAB") + rng.choice([" ", ", ", "-"]) for _ in range(n))
    listed = [(i, text(rng.randint(0, 9))) for i in range(12)] + [(3, "a b"), (3, "a b"), (None, "a"), (30, None)]
    rows = [(i, text(rng.randint(0, 25))) for i in range(60)] + [(7, None), (None, "A,b"), (8, "é b 1")]
    want = contaminated(rows, listed, 5)
    assert reported(decontaminate.contamination(docs(rows), items(listed), window=5)) == want
    assert reported(decontaminate.contamination(docs(rows), items(listed), window=5, block_chars=40)) == want


def test_items_without_id_hit_words_but_are_not_listed(docs, items):
    known = [(None, "one two three"), (7, "three four"), (None, " ".join(f"w{i}" for i in range(20)))]
    rows = [(1, "x one two three four y"), (2, " ".join(f"w{i}" for i in range(3, 18)))]
    found = decontaminate.contamination(docs(rows), items(known), 13)
    got = {r["doc_id"]: (r["n"], r["items"]) for r in found.select("doc_id", decontaminate.hit_words().alias("n"), "items").collect()}
    assert got == {1: (4, ["7"]), 2: (15, [])}


def test_contaminated_documents_go_and_long_spans_are_cut(docs, items):
    listed = items([(1, "one two three four five")])
    clean = " ".join(f"w{i}" for i in range(200))
    rows = [(1, "x one two three"), (2, f"{clean}. One, two three! {clean}"), (3, clean), (4, None)]
    kept = decontaminate.decontaminate(docs(rows), listed, window=3)
    assert ranks((r["doc_id"], r["text"]) for r in kept.collect()) == ranks(rows[1:])
    cut = decontaminate.decontaminate(docs(rows), listed, window=3, longest_span=2)
    assert {r["doc_id"]: r["text"] for r in cut.collect()}[2] == f"{clean}. ! {clean}"
    assert cut.columns == docs([]).columns


def test_contamination_edges(docs, items):
    listed = items([(1, LONG[:200]), (2, None), (3, "")])
    got = reported(decontaminate.contamination(docs(EDGES), listed))
    assert len(got) == len(EDGES)
    assert {r[0]: len(r[2]) for r in got}[6] > 179_900
    assert reported(decontaminate.contamination(docs([]), listed)) == []
    assert all(not r[2] for r in reported(decontaminate.contamination(docs(EDGES), items([]))))


# --- packing -----------------------------------------------------------------


@given(st.lists(st.integers(1, 60), max_size=40), st.integers(60, 90))
@settings(max_examples=60, deadline=None)
def test_local_search_keeps_every_piece_and_adds_no_bin(lengths, capacity):
    start = packing.best_fit(lengths, capacity)
    end = packing.improve([list(b) for b in start], lengths, capacity)
    assert sorted(i for b in end for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in end)
    assert -(-sum(lengths) // capacity) <= len(end) <= len(start)


def test_local_search_empties_bins():
    lengths = [6, 4, 7, 3, 5, 5]
    apart = [[0], [1], [2], [3], [4], [5]]
    assert len(packing.improve(apart, lengths, 10)) == 3
    swapped = packing.improve([[0, 3], [1, 4], [2], [5]], [5, 4, 5, 5, 4, 7], 10)
    assert len(swapped) <= 4


def test_ids_are_those_of_the_tokenizer():
    exact = packing._exact(packing.TOKENIZER)
    for text in ("", "a b", "It's 12\n\n  x\t", "é\xa0中 😀", "x <|endoftext|> y", "ab" * 5000, " \n "):
        assert packing.encode(text).tolist() == [*exact.encode(text, add_special_tokens=False).ids, 0]


def test_packing(docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 90)))) for i in range(300)]
    rows += EDGES
    rows += [(400 + i, edge + blank * 2_000_000 + edge) for i, (blank, edge) in enumerate(itertools.product(" \t\n", ("", "x")))]
    exact = packing._exact(packing.TOKENIZER)
    placed = packing.pack(docs(rows), capacity=64).collect()
    bins: dict[int, list] = {}
    for r in placed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    want = []
    for doc, text in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        starts = packing.cuts(len(ids), 64)
        for n, (a, b) in enumerate(itertools.pairwise([*starts, len(ids)])):
            assert b - a == 64 or n == 0
            want.append((doc, n, a, b - a, packing.zlib.crc32(ids[a:b].tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed]
    assert ranks(got) == ranks(want)
    assert len(bins) <= 1.1 * sum(w[3] for w in want) / 64 + 8
    assert packing.pack(docs([])).count() == 0


def test_token_sequences(docs):
    rows = [(i, "some words " * i) for i in range(40)]
    placed = packing.pack(docs(rows), capacity=32)
    sequences = {r["sequence_id"]: r["ids"] for r in packing.token_sequences(docs(rows), placed, 32).collect()}
    back: dict[int, list] = {}
    for r in placed.collect():
        part = sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        back.setdefault(r["doc_id"], []).append((r["start"], part))
    for doc, text in rows:
        assert [i for _, p in sorted(back[doc]) for i in p] == packing.encode(text).tolist()


def test_query_packs_every_document_with_the_ids_of_the_tokenizer(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    exact = packing._exact(packing.TOKENIZER)
    want, total = {}, 0
    for r in spark.read.parquet(path).collect():
        ids = np.array([*exact.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        for n, a in enumerate([0, *range(first, len(ids), 2048)]):
            part = ids[a : first if n == 0 else a + 2048]
            want[r["doc_id"], n] = (a, len(part), packing.zlib.crc32(part.tobytes()))
        total += len(ids)
    bins: dict[int, list] = {}
    got = {}
    for r in queries.QUERIES["op3_pack"](spark, "/root/testdata/sf0.001").collect():
        got[r["doc_id"], r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for parts in bins.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(bins) <= -(-total // 2048) + 1


# --- near-duplicates ---------------------------------------------------------


def components(rows, size, percent):
    sets = []
    for _, text in rows:
        words = lowered(text).encode().split()
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return ranks((doc, len(sets[i]), least[find(i)], doc == least[find(i)]) for i, (doc, _) in enumerate(rows))


def test_near_duplicates_are_those_of_brute_force(docs):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choices(words, k=60) for _ in range(25)]

    def near(source, changes):
        out = list(source)
        for _ in range(changes):
            out[rng.randrange(len(out))] = rng.choice(words)
        return " ".join(out)

    texts = [near(rng.choice(base), rng.randint(0, 5)) for _ in range(150)]
    texts += [near(base[0], rng.randint(1, 4)) for _ in range(150)]
    texts += ["", None, "a", "A", "a b", "A  b", "b a", " \n", texts[0].upper()]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = neardup.near_duplicates(docs(rows), words=2)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = components(rows, 2, 80)
    assert ranks(tuple(r) for r in got.collect()) == want
    kept = neardup.representatives(docs(rows), words=2)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(w[0] for w in want if w[3])
    assert kept.columns == docs([]).columns


def test_the_sets_of_a_family_meet_once(docs, monkeypatch):
    """Entries are opened again only where families are too large, with the same result."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    base = [rng.choices(words, k=80) for _ in range(6)]
    rows = []
    for i in range(120):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(80)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    within, opened = neardup._within_entries, []

    def counted(scratch, members, *rest):
        opened.append(members.count())
        return within(scratch, members, *rest)

    monkeypatch.setattr(neardup, "_within_entries", counted)
    want = components(rows, 2, 80)
    assert ranks(tuple(r) for r in neardup.near_duplicates(docs(rows), words=2).collect()) == want
    monkeypatch.setattr(neardup, "_FAMILY_ELEMENTS", 100)
    assert ranks(tuple(r) for r in neardup.near_duplicates(docs(rows), words=2).collect()) == want
    assert opened[0] < opened[1] / 10


def test_near_duplicate_edges(docs):
    got = ranks(tuple(r) for r in neardup.near_duplicates(docs(EDGES)).collect())
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (5, 0, 5, True) in got
    assert (3, 1, 3, True) in got and (4, 1, 3, False) in got
    assert got.count((7, 3, 6, False)) == 2 and (6, 3, 6, True) in got
    assert (None, 1, None, True) in got
    assert neardup.near_duplicates(docs([])).count() == 0


def test_rows_that_share_a_doc_id_are_one_document(docs):
    a, b, c = ("one two three four five", "six seven eight nine ten", "eleven twelve thirteen")
    rows = [(1, a), (2, a), (2, b), (3, b), (2, None), (5, c), (4, ""), (4, c), (9, "x y"), (9, "z"), (None, b)]
    got = [tuple(r) for r in neardup.near_duplicates(docs(rows), words=2).collect()]
    component = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 9, None: 1}
    n = {a: 4, b: 4, c: 2, "x y": 1, "z": 1, "": 0, None: 0}
    assert ranks(got) == ranks((d, n[t], component[d], d in (1, 4, 9, None)) for d, t in rows)
    kept = neardup.representatives(docs(rows), words=2).collect()
    assert ranks((r["doc_id"], r["text"]) for r in kept) == ranks(r for r in rows if r[0] in (1, 4, 9, None))


def test_shared_doc_ids_are_those_of_brute_force(docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choices(words, k=40) for _ in range(30)]
    rows = []
    for _ in range(120):
        text = list(rng.choice(base))
        text[rng.randrange(40)] = rng.choice(words)
        rows.append((rng.randrange(200), rng.choice([" ".join(text)] * 9 + [""])))
    whole = components(rows, 2, 80)
    parent = {d: d for d, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for d, _, component, _ in whole:
        one, two = find(d), find(component)
        parent[max(one, two)] = min(one, two)
    want = ranks((d, n, find(d), d == find(d)) for d, n, _, _ in whole)
    assert want != whole
    assert ranks(tuple(r) for r in neardup.near_duplicates(docs(rows), words=2).collect()) == want


# --- substrings --------------------------------------------------------------


def cut(rows, window):
    split = [(d, (t or "").encode().split()) for d, t in rows]
    least: dict[tuple, float] = {}
    rank = lambda d: float("inf") if d is None else d
    for d, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            least[key] = min(rank(d), least.get(key, float("inf")))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < rank(d):
                gone |= set(range(i, i + window))
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), left.decode()))
    return ranks(out)


@pytest.mark.parametrize(
    ("letters", "window", "hot_rows"),
    [("ab", 8, 5_000), ("abcdefgh", 6, 5_000), ("abcdefgh", 6, 3), ("abcdefghijklmnopqrstuvwxyz", 50, 5_000)],
)
def test_removed_words_are_those_of_brute_force(docs, monkeypatch, letters, window, hot_rows):
    monkeypatch.setattr(substrings, "HOT_ROWS", hot_rows)
    rng = random.Random(window)
    passages = [rng.choices(letters, k=rng.randint(window - 2, 3 * window)) for _ in range(12)]
    passages += [["a"] * 3 * window, ["a", "b"] * 2 * window]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices(letters, k=rng.randint(0, 2 * window))
            source = rng.choice(passages)
            start = rng.randrange(len(source))
            words += source[start : start + rng.randint(1, len(source))] if rng.random() < 0.5 else source
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(90, rows[5][1]), (91, rows[5][1]), (5, rows[5][1])]
    rng.shuffle(rows)
    got = substrings.remove_repeated(docs(rows), window)
    assert ranks(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept").collect()) == cut(rows, window)


def test_substring_edges(docs):
    want = cut([(d, t if t is None or len(t) < 10**5 else t[:1800]) for d, t in EDGES], 50)
    rows = [(d, t if t is None or len(t) < 10**5 else t[:1800]) for d, t in EDGES]
    got = substrings.remove_repeated(docs(rows)).select("doc_id", "n_words", "n_removed", "kept")
    assert ranks(tuple(r) for r in got.collect()) == want
    long = substrings.remove_repeated(docs(EDGES)).where("n_words > 1000").collect()
    assert ranks((r["doc_id"], r["n_removed"]) for r in long) == [(6, 0), (7, 180_000), (7, 180_000)]
    assert substrings.remove_repeated(docs([])).count() == 0
    left = substrings.deduplicate(docs(EDGES))
    assert left.columns == docs([]).columns
    assert ranks(r["doc_id"] for r in left.collect()) == ranks([1, 2, 3, 4, 5, 6, None])
    assert {r["doc_id"]: r["text"] for r in left.collect()}[5] == " \n\t "


# --- WARC --------------------------------------------------------------------


def test_any_split_of_an_archive_reads_every_record_once(tmp_path):
    rng = random.Random(3)
    path, places, bodies = tmp_path / "a.warc.gz", [], []
    with path.open("wb") as out:
        for i in range(25):
            body = rng.randbytes(rng.choice([0, 5, 400, 30_000])) + warc.MAGIC * (i % 3)
            places.append(out.tell())
            bodies.append(body)
            out.write(warc.record("response", i, "u", body, len(body), warc.digest(body), None, "2026-01-01T00:00:00Z"))
        out.write(warc.MAGIC + b"\0" * 40)
    size = path.stat().st_size
    for step in (size, 50_000, 777, 64):
        found = [m for s in range(0, size, step) for m in warc.members(str(path), s, min(s + step, size))]
        assert [p for p, _ in found] == places
        assert [warc.parse(c)[1] for _, c in found] == bodies


def test_archive_and_read(spark):
    reachable(spark)
    rows = [(1, "http://a", "x"), (2, "b\r\nEvil: 1", "x"), (3, None, "é" * 10), (4, "d", None), (5, "e", "")]
    rows += [(6, "f", LONG), (6, "f", LONG), (None, "g", "x"), (7, "h", "x")]
    pages = spark.createDataFrame([(*r, "?") for r in rows], "page_id bigint, url string, html string, sha string")
    read = warc.read(warc.archive(pages, file_bytes=500), range_bytes=100)
    got = ranks((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in read.collect())
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        last = max(p for p, _, h in rows if (h or "") == (html or "") and p is not None)
        kind = "response" if page == last else "revisit"
        want.append((page, kind, None if page == last else last, len(body), warc.digest(body)))
    assert got == ranks(want)
    bodies = {r["page_id"]: r["payload"] for r in read.where("record_type = 'response'").collect()}
    assert bodies[6].decode() == LONG and bodies[3].decode() == "é" * 10
    files = [f["path"] for f in warc.archive(pages).collect()]
    assert all(re.match(r"\w+:/", f) for f in files)
    heads = [warc.parse(c)[0] for f in files for _, c in warc.members(f, 0, 1 << 40)]
    ids = {h["x-page-id"]: h["warc-record-id"] for h in heads if h["warc-type"] == "response"}
    for h in heads:
        assert re.fullmatch(r"20\d\d-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["warc-date"]) and ("warc-profile" in h) == (h["warc-type"] == "revisit")
        assert h.get("warc-refers-to") == (ids[h["x-refers-to"]] if h["warc-type"] == "revisit" else None)
    urls = {r["page_id"]: r["url"] for r in read.collect()}
    assert urls[2] == "b Evil: 1" and urls[3] is None
    assert warc.read(warc.archive(pages.limit(0))).count() == 0


# --- sharding ----------------------------------------------------------------


def test_shards_get_equal_shares_and_keep_their_slots():
    names = [f"s{i}" for i in range(7)]
    before = sharding.fill(names, 1009)
    shares = [before.count(i) for i in range(7)]
    assert max(shares) - min(shares) <= 1
    after = sharding.fill(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 6)
    assert moved < 0.25 * 1009
    for size in (4, 1, 2):
        with pytest.raises(ValueError):
            sharding.fill(names, size)
    with pytest.raises(ValueError):
        sharding.fill([], 7)


def test_placement(docs):
    rows = EDGES + [(8, "x")] * 50
    placed = sharding.place(docs(rows), "doc_id", ["a", "b", "c"], 101)
    got = placed.select("doc_id", "slot", "shard").collect()
    table = sharding.fill(["a", "b", "c"], 101)
    assert len(got) == len(rows)
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r["slot"], r["shard"]) == (slot, "abc"[table[slot]])
    plan = placed._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert sharding.place(docs([]), "doc_id", ["a"], 101).count() == 0


# --- chat --------------------------------------------------------------------


@given(st.text(alphabet="\\#<:hlc /turn> ?é\n"), st.text(alphabet="user?:\\#< é"))
def test_texts_and_roles_come_back(text, role):
    template = chat.Template()
    escaped = template.escape(text)
    assert template.unescape(escaped) == text
    assert not re.search(r"[#<]", escaped)
    assert template.role(template.head(role)) == role


def test_chat(spark):
    reachable(spark)
    rows = [
        (1, 1, "assistant", "fine <b>"),
        (1, 0, "user", "how\\n are #1"),
        (2, 0, "assistant", "too early"),
        (2, 1, "user", None),
        (3, 0, "system", ""),
        (3, 1, "user", "q"),
        (3, 2, "assistant", LONG),
        (3, 2, "assistant", LONG),
        (4, 0, None, "x"),
        (4, None, "weird: role", "y"),
        (None, 0, "user", "z"),
    ]
    rows += [(5, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(3000)]
    frame = spark.createDataFrame([(*r, "?") for r in rows], "conv_id bigint, turn bigint, role string, text string, loss string")
    segments = chat.format_conversations(frame)
    got = {r["conv_id"]: r for r in chat.read_digests(segments).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv, r in got.items():
        turns = [(t, o or "", x or "") for c, t, o, x in rows if c == conv]
        turns.sort(key=lambda t: (-1 if t[0] is None else t[0], t[1], t[2]))
        said = "".join(f"{o}\n{x}\n" for _, o, x in turns)
        learned = "".join(x for _, o, x in turns if o == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert {c: r["valid"] for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: True, None: True}
    # Wherever segments end: one for each run of characters of one flag, of three characters at most.
    cut = "explode(transform(sequence(0, greatest((length(text) - 1) div 3, 0)), i -> struct(i, substring(text, i * 3 + 1, 3) AS p)))"
    fine = segments.where("conv_id < 3").selectExpr("conv_id", "position", "loss", "valid", f"{cut} AS c")
    fine = fine.selectExpr("conv_id", "position * 1000 + c.i AS position", "c.p AS text", "loss", "valid")
    assert {r["conv_id"]: r for r in chat.read_digests(fine).collect()} == {c: got[c] for c in (1, 2)}
    text = "".join(r["text"] for r in segments.where("conv_id = 1").orderBy("position").collect())
    assert text == "### User: how\\\\n are \\h1 </turn>\n### Assistant: fine \\lb> </turn>\n"
    assert chat.read_digests(chat.format_conversations(frame.limit(0))).count() == 0


# --- top-k -------------------------------------------------------------------


def best(rows, is_query, k):
    known = [
        (id_, [int(np.floor(64 * x)) for x in v])
        for id_, v in rows
        if id_ is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    met: dict[int, list] = {}
    for q, x in known:
        if is_query(q):
            scores = [(-sum(a * b for a, b in zip(x, y)), c) for c, y in known if c != q]  # noqa: B905
            met[q] = met.get(q, []) + scores
    return ranks((q, n + 1, c, -s) for q, found in met.items() for n, (s, c) in enumerate(sorted(found)[:k]))


@pytest.mark.parametrize("big", [False, True])
def test_top_k_is_that_of_brute_force(spark, big):
    reachable(spark)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.5, -0.25, 0.1, 0.3]) for _ in range(12)]) for i in range(150)]
    rows += [(200, None), (201, [None] * 12), (202, [float("nan")] * 12), (203, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(204, []), (205, [1.0]), (206, [0.1] * 20), (7, [2.0] * 12), (7, [2.0] * 12), (0, [1.5] * 12)]
    rows += [(20, rows[20][1]), (7, [1.75] * 12), (40, [2.5] * 12)]
    if big:
        rows = rows[:60] + [(300, [1e9] * 12), (320, [-1e9] * 12)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, score int").repartition(3)
    got = topk.exact_top_k(frame, F.col("vec_id") % 20 == 0, k=7, dimensions=4, query_block=4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert ranks(tuple(r) for r in got.collect()) == best(rows, lambda q: q % 20 == 0, 7)
    assert topk.exact_top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_the_largest_doubles(spark):
    reachable(spark)
    rows = [(0, [1e308, 1.0]), (1, [1e308, 1.0]), (2, [-1e308, 1.0]), (3, [0.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.exact_top_k(frame, F.col("vec_id") == 0).collect()
    assert [tuple(r)[1:] for r in got] == [(1, 1, (1 << 63) - 1), (2, 3, 64 * 128), (3, 2, -(1 << 63))]


def test_queries_of_a_block_limit_each_other():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(size=(300, 8)) * 64)
    ids = np.arange(300) // 2 * 20
    least = topk._least_among(ids, vectors, 5, 4)
    scores = (vectors @ vectors.T).astype(int)
    for row in range(len(ids)):
        others = np.sort(scores[row][ids != ids[row]])
        assert least[row] == others[-5]


# --- licences ----------------------------------------------------------------


def test_licences(docs):
    mit = licences.TEXTS["MIT"]
    variants = [
        mit,
        "MIT?\n".replace("MIT?\n", "") + "Copyright (c) 2020 Someone\n\n" + mit.replace("\n", "  \n"),
        "© 1999 A\nAll rights reserved.\n" + mit.upper().replace("SUBLICENSE", "sub-licence"),
    ]
    rows = [(i, v) for i, v in enumerate(variants)]
    rows += [(10, mit + " and more"), (11, "x\nReleased under the MIT License.\ny"), (12, "LICENSED UNDER CC BY-NC 4.0!\nReleased under MIT licence")]
    rows += [(20, None), (21, ""), (22, "Copyright 2020 me"), (23, LONG), (11, "x"), (11, "x"), (None, "Released under the ISC License")]
    got = licences.scan(docs(rows)).collect()
    assert len(got) == len(rows)
    whole = {r["doc_id"]: r["licence"] for r in got}
    assert [whole[i] for i in (0, 1, 2)] == ["MIT"] * 3 and whole[10] is None
    assert whole[None] == "ISC License"
    notices = {(r["doc_id"], r["digest"]): r["notices"] for r in got}
    assert sorted(n for (d, _), n in notices.items() if d == 11) == [[], ["MIT License"]]
    assert [n for (d, _), n in notices.items() if d == 12] == [["CC BY-NC 4.0", "MIT License"]]
    assert notices[(20, None)] == notices[(21, None)] == notices[(22, None)] == []
    assert licences.scan(docs([])).count() == 0
    assert "Python" not in licences.scan(docs(rows))._jdf.queryExecution().toString()


def test_licence_files_with_their_titles(docs):
    texts = licences.TEXTS
    want = {
        "MIT License\n\nCopyright (c) 2020 Someone\n\n" + texts["MIT"]: "MIT",
        "The MIT License (MIT)\n\nCopyright © 2020 A\n\n" + texts["MIT"].replace("\n", " "): "MIT",
        "ISC License\n\nCopyright 2019, B\n\n" + texts["ISC"]: "ISC",
        "zlib License\n\n(C) 2011 C\n\n" + texts["Zlib"]: "Zlib",
        "BSD Zero Clause License\n" + texts["0BSD"]: "0BSD",
        "BSD 2-Clause License\n\nCopyright (c) 2020, D\nAll rights reserved.\n\n" + texts["BSD-2-Clause"]: "BSD-2-Clause",
        "Copyright (c) 2020, E\n" + re.sub(r"(?m)^\d\.", " *", texts["BSD-3-Clause"]): "BSD-3-Clause",
        texts["MIT"] + "\nMIT License": None,
        "MIT License": None,
    }
    for file in sorted(licences.FILES.glob("*.txt")):
        want[re.sub(" +", "  ", file.read_text(encoding="utf-8"))] = file.stem
    assert len(want) == 14
    got = licences.scan(docs(list(enumerate(want)))).collect()
    assert {r["doc_id"]: r["licence"] for r in got} == dict(enumerate(want.values()))


def test_neighbouring_words_have_one_spelling(docs):
    words = ("licence", "license", "sub licence", "sublicense", "non commercial", "noncommercial")
    rows = [(n, f"a {other} {other} {other} b") for n, other in enumerate(words)]
    digests = {r["doc_id"]: r["digest"] for r in licences.scan(docs(rows)).collect()}
    assert digests[0] == digests[1] and digests[2] == digests[3] and digests[4] == digests[5]
    assert len(set(digests.values())) == 3


def test_licences_given_as_a_table(spark, docs):
    known = spark.createDataFrame([("Own", "My own licence!", 1)], "licence string, text string, digest int")
    got = licences.scan(docs([(1, "my OWN license"), (2, "other")]), known).collect()
    assert {r["doc_id"]: r["licence"] for r in got} == {1: "Own", 2: None}


def test_ids_do_not_need_look_ahead():
    """The fast pattern has none, and blanks of all kinds give the ids of ``tokenizers``."""
    fast, exact = packing._fast(packing.TOKENIZER), packing._exact(packing.TOKENIZER)
    assert "(?" not in fast._pat_str
    rng = random.Random(8)
    parts = ["a", "B", "é", "9", "'s", "'", "'ll", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0"]
    parts += [" ", "᠎", " ", " ", " ", " ", "　", "​", "﻿", "漢", "!", "-", "\0"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        want = exact.encode(text, add_special_tokens=False).ids
        assert packing.encode(text).tolist() == [*want, packing.END], repr(text)
