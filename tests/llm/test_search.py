"""Language identification, ranked lexical search and centroid clustering against plain Python."""

from __future__ import annotations

import binascii
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from docstrata.llm import centroids, languages, lexical, queries
from docstrata.llm.tables import reachable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _reachable(spark):
    reachable(spark)


# --- languages ----------------------------------------------------------------


def folded(text: str) -> list[int]:
    out = []
    for b in text.encode():
        if ord("A") <= b <= ord("Z"):
            b += 32
        out.append(b if b >= 128 or ord("a") <= b <= ord("z") else 32)
    return out


def plain_profile(text: str) -> np.ndarray:
    data = folded(text)
    counts = np.zeros(languages.BUCKETS)
    for size in languages.SIZES:
        for i in range(len(data) - size + 1):
            gram = data[i : i + size]
            if any(a == b == 32 for a, b in zip(gram[:-1], gram[1:], strict=True)):
                continue
            number = 0
            for b in gram:
                number = number * 256 + b
            mixed = (number + size) * 2654435761 % 2**32
            mixed = (mixed ^ (mixed >> 15)) * 2246822519 % 2**32
            counts[mixed >> (32 - 13)] += 1
    return np.sqrt(counts / max(1, counts.sum()))


TEXTS = ["", "a", "Ab", "the cat  -- sat\non the mat", "ñandú, él", "日本語 text", "x" * 300, "  ..  ", "Q\0q"]


def test_profiles_equal_plain_counts(monkeypatch):
    got = np.concatenate(list(languages.profiles(pa.array(TEXTS))))
    want = np.array([plain_profile(t) for t in TEXTS])
    assert np.allclose(got, want, atol=1e-6)
    monkeypatch.setattr(languages, "_SLICE", 3)
    assert np.array_equal(got, np.concatenate(list(languages.profiles(pa.array(TEXTS)))))


def plain_prediction(model: languages.Model, x: np.ndarray) -> str:
    margins = [float(x @ w[:-1] + w[-1]) for w in model.of_family.T]
    family = max(range(len(margins)), key=lambda f: margins[f]) if len(margins) > 1 else 0
    names = model.families[family]
    votes, sums = [0] * len(names), [0.0] * len(names)
    for a, b, w in model.pairs[family]:
        m = float(x @ w[:-1] + w[-1])
        votes[a if m >= 0 else b] += 1
        sums[a] += m
        sums[b] -= m
    return names[max(range(len(names)), key=lambda i: (votes[i], sums[i], -i))]


def test_query_equals_plain_prediction_and_names_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = languages.train(docs, ~languages.held_out())
    want = {}
    for r in docs.collect():
        x = plain_profile(r["text"]).astype(np.float32).astype(float)
        want[r["doc_id"]] = (
            r["lang"],
            binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2,
            plain_prediction(model, x) if re.search(r"[^\W\d_]", r["text"]) else "und",
        )
    got = queries.QUERIES["op11_language"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["held_out"], r["lang_pred"]) for r in got} == {d: w[1:] for d, w in want.items()}
    assert all(0 <= r["score"] <= 1 for r in got)
    right = [lang == pred for lang, out, pred in want.values() if out]
    assert len(right) > 30 and sum(right) >= 0.95 * len(right)


def test_model_does_not_learn_from_held_out_rows_or_their_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    other = docs.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'qqq' ELSE text END AS text",
        "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang",
    )
    one, two = (languages.train(d, ~languages.held_out()) for d in (docs, other))
    assert one.families == two.families and np.array_equal(one.of_family, two.of_family)


def test_families_and_unlisted_languages():
    x = np.eye(6, dtype=np.float32)
    model = languages.fit(x, np.array(["de", "en", "es", "xx", "yy", "en"], object))
    assert model.families == (("de", "en"), ("es",), ("xx",), ("yy",))
    assert [len(p) for p in model.pairs] == [1, 0, 0, 0]
    names, scores = model.predict(x)
    assert names.tolist() == ["de", "en", "es", "xx", "yy", "en"]
    assert ((scores > 0) & (scores <= 1)).all()


def test_language_edges(spark):
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "12 .. 3", "en"), (4, "the and of " * 9, "en"), (4, "the and of " * 9, "en"),
        (5, "der und die das " * 9, "de"), (None, "le la les", "fr"), (7, "el los las", None), (8, "ж", "de"),
        (9, "der und " * 200_000, "de"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.train(docs, languages.held_out().isNotNull())
    assert model.families == (("de", "en"),)
    named = docs.selectExpr("*", "1 AS score", "2 AS LANG_PRED", "3 AS _found")
    found = languages.identify_languages(named, model)
    assert found.columns == ["doc_id", "text", "lang", "_found", "lang_pred", "score"]
    got = {(r["doc_id"], r["lang"]): (r["lang_pred"], r["score"]) for r in found.collect()}
    assert found.count() == len(rows)
    assert [got[d, "en"] for d in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4, "en"][0] == "en" and got[5, "de"][0] == "de" and got[9, "de"][0] == "de"
    assert found.where("score < 0 OR score > 1").isEmpty()
    nothing = languages.train(docs.where("doc_id = 7"), languages.held_out().isNotNull())
    assert {r["lang_pred"] for r in languages.identify_languages(docs, nothing).collect()} == {"und"}
    only = languages.train(docs.where("lang = 'de'"), languages.held_out().isNotNull())
    assert {r[0]: r[1] for r in languages.identify_languages(docs.where("doc_id = 4"), only).select("lang_pred", "score").collect()} == {"de": 1.0}
    assert languages.identify_languages(docs.limit(0), model).count() == 0
    assert not docs.select(languages.held_out().isNull().alias("n")).where("n").count()


# --- ranked search --------------------------------------------------------------

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs: list, items: list, k: int) -> list[tuple]:
    split = [(d, terms(t)) for d, t in docs]
    split = [(d, t) for d, t in split if t]
    n_docs, length = len(split), sum(len(t) for _, t in split)
    out = []
    for item, text in items:
        scores = []
        for doc, own in split:
            m = 50 + (50 * len(own) * n_docs) // length
            score = 0
            for term in set(terms(text)):
                df = sum(term in o for _, o in split)
                tf = own.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return out


def searched(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.ranked_search(d, i, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


WORDS = ["a", "B", "été", "ÉTÉ", "x1", "日本"]


@settings(max_examples=12, deadline=None)
@given(st.data())
def test_ranked_search_equals_plain_python(spark, data):
    text = st.one_of(st.none(), st.lists(st.sampled_from([*WORDS, ".", "\n"]), max_size=9).map(" ".join))
    docs = list(enumerate(data.draw(st.lists(text, max_size=25))))
    items = list(enumerate(data.draw(st.lists(text, max_size=5))))
    options = {"k": data.draw(st.integers(1, 4)), "width": data.draw(st.sampled_from([1, 2, 64]))}
    options["share"] = data.draw(st.sampled_from([1, 2, 32]))
    want = sorted(plain_search(docs, items, options["k"]), key=repr)
    assert searched(spark, docs, items, **options) == want


def test_ranked_search_edges(spark):
    docs = [(1, "a b"), (1, "a b"), (2, "a b"), (None, "a b"), (3, None), (4, ""), (5, "..."), (6, "a " * 50_000), (7, "c")]
    items = [(1, "a"), (1, "a"), (None, "b"), (4, None), (5, "!"), (6, "zzz"), (7, "A a A")]
    want = plain_search(docs, items, 50)
    assert searched(spark, docs, items) == sorted(want, key=repr)
    assert searched(spark, [], items) == [] == searched(spark, docs, [])
    assert searched(spark, docs, items, k=2) == sorted(plain_search(docs, items, 2), key=repr)


def test_ranked_search_in_batches_and_with_clashing_columns(spark, monkeypatch):
    docs = [(d, " ".join(WORDS[: 1 + d % 6]) + f" w{d}") for d in range(60)]
    items = [(i, f"{WORDS[i % 6]} w{i}") for i in range(30)]
    want = sorted(plain_search(docs, items, 3), key=repr)
    whole = lexical.batches
    monkeypatch.setattr(lexical, "batches", lambda i: whole(i, batch_bytes=100, batch_items=4))
    assert len(list(lexical.batches(spark.createDataFrame(items, "item_id long, text string")))) > 3
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS N", "2 AS score", "3 AS Terms")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS TEXT")
    got = lexical.ranked_search(d, i, k=3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_sketches_bound_scores_and_spare_work(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    texts = [r["text"] for r in docs.collect()]
    batch = lexical.Items.of([r["item_id"] for r in items], [r["text"] for r in items])
    postings = lexical._postings(type("Shared", (), {"value": batch}))
    (rows,) = postings(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})]))
    weights = np.full(len(batch.terms), 1000)
    least = np.ones(len(items), np.int64)
    search = lexical.Search(batch, weights, len(texts), int(rows["n"].to_numpy().sum()), 5, 256, least)
    best = lexical.Best(search)
    asked = []
    exact = lexical.exact_scores
    monkeypatch.setattr(lexical, "exact_scores", lambda r, *a: asked.append(len(r)) or exact(r, *a))
    first = rows["terms"].offsets.to_numpy().astype(np.int64)
    arguments = first, rows["terms"].flatten().to_numpy(), rows["times"].flatten().to_numpy()
    n = rows["n"].to_numpy()
    best.meet(rows["doc_id"].to_numpy(), np.ones(len(rows), bool), n, *arguments)
    assert sum(asked) < len(items) * len(rows) / 2
    row = np.repeat(np.arange(len(rows)), np.diff(first))
    impacts = search.impacts(n, row, *arguments[1:])
    bounds = best.sketch(len(rows), row, arguments[1], impacts) @ best.lookup
    for item in range(len(items)):
        member = np.zeros(len(batch.terms), bool)
        member[batch.members[batch.first[item] : batch.first[item + 1]]] = True
        scores = exact(np.arange(len(rows)), first, arguments[1], impacts, member)
        assert (scores <= bounds[:, item]).all()
        assert sorted(scores.tolist())[-5:] == sorted(best.scores[item].tolist())


def test_impacts_beyond_64_bits_of_intermediate_results():
    items = lexical.Items.of([1], ["a"])
    search = lexical.Search(items, np.array([5]), 10**12, 10**15, 5, 4, np.ones(1, np.int64))
    n, times = np.array([10**11, 3]), np.array([10**10, 3])
    want = [5 * ((10**9 * t) // (1000 * t + 20 * (50 + 50 * x * 10**12 // 10**15))) for x, t in zip(n.tolist(), times.tolist())]
    assert search.impacts(n, np.arange(2), np.zeros(2, np.int64), times).tolist() == want


# --- centroids --------------------------------------------------------------------


def plain_clusters(rows: list, dimensions: int, k: int, rounds: int, scale: int, seed: int) -> list[tuple]:
    kept = []
    for vec_id, v in rows:
        if v is None or len(v) != dimensions or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in v], v))

    def place(row):
        digest = hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest()
        return (row[0] is None, "" if row[0] is None else digest, row[2])

    centre = [e for _, e, _ in sorted(kept, key=place)[:k]]

    def nearest(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c, strict=True)), n) for n, c in enumerate(centre))

    for _ in range(rounds):
        of = [nearest(e)[1] for _, e, _ in kept]
        for n in range(len(centre)):
            own = [e for (_, e, _), c in zip(kept, of, strict=True) if c == n]
            if own:
                centre[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [nearest(e) for _, e, _ in kept]
    most = 2**63 - 1
    spent = [sum(min(d, most) for d, c in last if c == n) for n in range(len(centre))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return [
        (i, c, min(d, most), min(spent[c], most), min(sum(spent), most), digest[c])
        for (i, _, _), (d, c) in zip(kept, last, strict=True)
    ]


def clustered(spark, rows, dimensions, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = centroids.cluster(df, dimensions, **options)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@settings(max_examples=8, deadline=None)
@given(st.data())
def test_clusters_equal_plain_python(spark, data):
    number = st.one_of(st.integers(-3, 3).map(lambda x: x / 4), st.floats(-1, 1))
    number = st.one_of(number, st.sampled_from([None, float("nan"), float("inf")])) if data.draw(st.booleans()) else number
    vectors = data.draw(st.lists(st.one_of(st.none(), st.lists(number, min_size=3, max_size=3), st.lists(number, max_size=4)), max_size=40))
    rows = [(None if n % 11 == 7 else n // 2, v) for n, v in enumerate(vectors)]
    k, rounds = data.draw(st.integers(1, 9)), data.draw(st.integers(0, 4))
    want = sorted(plain_clusters(rows, 3, k, rounds, 1024, 3), key=repr)
    assert clustered(spark, rows, 3, k=k, rounds=rounds) == want


def test_clusters_of_numbers_beyond_64_bits(spark):
    rows = [(n, [1.5e300 * (n % 3), -3.0 * n, 1e30 / (n + 1)]) for n in range(9)]
    assert clustered(spark, rows, 3, k=3, rounds=3) == sorted(plain_clusters(rows, 3, 3, 3, 1024, 3), key=repr)


def test_clusters_of_nothing_and_of_few(spark):
    assert clustered(spark, [], 3) == []
    assert clustered(spark, [(1, None), (2, [1.0])], 3) == []
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 1.0])]
    assert clustered(spark, rows, 2) == sorted(plain_clusters(rows, 2, 8, 10, 1024, 3), key=repr)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS Cluster", "2 AS VECTOR")
    assert centroids.cluster(df, 2).count() == 3


@pytest.mark.parametrize("k", [1, 2, 3, 8, 50, 300])
def test_vantage_tree_finds_the_nearest_and_prunes(k, monkeypatch):
    random = np.random.RandomState(k)
    groups = random.randint(-100_000, 100_000, (max(1, k // 6), 8))
    centre = groups[random.randint(0, len(groups), k)] + random.randint(-9, 10, (k, 8))
    centre[-1] = centre[0]  # equally near ones
    vectors = centre[random.randint(0, k, 500)] + random.randint(-9, 10, (500, 8))
    visited = []
    squares = centroids.squares
    monkeypatch.setattr(centroids, "squares", lambda v, c: visited.append(len(v)) or squares(v, c))
    tree = centroids.VantageTree(centre)
    visited.clear()
    nearest, distance = tree.nearest(vectors)
    whole = ((vectors[:, None, :] - centre[None]) ** 2).sum(axis=2)
    assert np.array_equal(nearest, whole.argmin(axis=1))
    assert np.array_equal(distance, whole.min(axis=1))
    if k >= 50:
        assert sum(visited) < 0.5 * whole.size
