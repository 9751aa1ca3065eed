"""Large arrays: every way of cutting a file into ranges gives the elements of the plain parser."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from test_pipeline import SPEC, document

import docstrata as ds
from docstrata.sources import arrays


def ranges(data: bytes, cuts: list[int]) -> list[tuple[int, list[bytes]]]:
    """Lines of the ranges as the reader deals them: a line belongs to the range that its
    first byte is in, or the byte before for the first byte of a range."""
    lines, at = [], 0
    while at < len(data):
        end = data.find(b"}", at)
        end = len(data) if end < 0 else end
        lines.append((at, data[at:end]))
        at = end + 1
    starts = [0, *sorted(set(cuts))]
    out = {s: [] for s in starts}
    for at, line in lines:
        owner = max((s for s in starts if s < at), default=0)
        out[owner].append(line)
    return [(s, ls) for s, ls in out.items() if ls]


def found(data: bytes, cuts: list[int]) -> list[bytes]:
    summaries = []
    dealt = ranges(data, cuts)
    for start, lines in dealt:
        s = arrays.Summary()
        for part in (b"}".join(lines), b"}"):
            if part:
                s.read(np.frombuffer(part, np.uint8))
        summaries.append((start, s))
    rows = [
        {"file": 1, "block": b, "bytes": len(data), "size": s.size, "first": s.first, "states": s.state, "depths": s.depth}
        for b, s in summaries
    ]
    pieces = []
    if not rows:
        return []
    import pyarrow as pa

    starts = arrays._starts(pa.Table.from_pylist(rows, arrays._SUMMARY_ARROW)).to_pylist()
    for (_, lines), r in zip(dealt, starts, strict=True):
        cutter = arrays.Cutter(r["state"], r["depth"], r["is_array"], r["block"] == 0)
        for n, line in enumerate(lines):
            pieces += cutter.read((b"}" if n else b"") + line)
        if r["ends"] != arrays._ENDS_BARE:
            pieces += cutter.read(b"}")
        pieces.append(cutter.end(r["ends"] != arrays._GOES_ON))
    out, chain = [], []
    for p in pieces:
        chain.append(p)
        if p.right is not None:
            text = arrays.resolve(arrays.Piece(chain[0].left, p.right, b"".join(c.text for c in chain)))
            out += [] if text is None else [text]
            chain = []
    assert not chain
    return out


def plain(data: bytes) -> list | None:
    """The documents of a text, None if it is malformed."""
    try:
        value = json.loads(data)
    except ValueError:
        return None
    return value if isinstance(value, list) else [value]


def parsed(texts: list[bytes]) -> list | None:
    try:
        return [json.loads(t) for t in texts]
    except ValueError:
        return None


HARD = [
    b'[{"a":"}{][,\\"\\\\"},{"b":[1,{"c":"\\\\\\""}]}, null ,[],"},{", 5 ]',
    b'  {"a":[1,2],"b":"}"}\n',
    b"[]",
    b" [ ] ",
    b'[{}]',
    b'[{"a":"\\\\"},{"b":"\\\\\\\\"}]\n\n',
    '[{"é":"日本}"},{"x":"\u007f"}]'.encode(),
]


@pytest.mark.parametrize("data", HARD)
def test_every_split_point(data):
    want = plain(data)
    for a in range(len(data) + 1):
        for b in range(a, len(data) + 1):
            assert parsed(found(data, [x for x in (a, b) if 0 < x < len(data)])) == want, (a, b)


WRONG = [
    b'[{"a":1},]', b'[,{"a":1}]', b'[{"a":1}', b'[{"a":1}] x', b'[{"a":1}][{"b":2}]', b'x [{"a":1}]', b'[{"a":1}]}', b'[{"a":1},,{}]',
    b'[{"a":1}]]', b'{"a":1} {', b'[{"a":1]', b'[{"a":"}]', b'{"a":1}}',
]


@pytest.mark.parametrize("data", WRONG)
def test_malformed_files_have_a_malformed_element(data):
    assert plain(data) is None
    for a in range(len(data) + 1):
        assert parsed(found(data, [a] if 0 < a < len(data) else [])) is None, a


JSON = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(), st.text(st.sampled_from('a"\\{}[],: é\n'), max_size=6)),
    lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.text(st.sampled_from('k"}\\'), max_size=3), x, max_size=3)),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(JSON, max_size=6), st.lists(st.integers(1, 400), max_size=6), st.sampled_from([None, 1]), st.booleans())
def test_any_array_at_any_split_points(value, cuts, indent, plain_text):
    data = json.dumps(value, indent=indent, ensure_ascii=plain_text).encode()
    assert parsed(found(data, [c for c in cuts if c < len(data)])) == value


@pytest.fixture
def split_at(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def at(size: int) -> None:
        for n in names:
            spark.conf.set(n, str(size))

    yield at
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_files_split_over_tasks(spark, tmp_path, split_at, size):
    split_at(size)
    (tmp_path / "site_data_1_1.json").write_bytes(HARD[0])
    (tmp_path / "site_data_2_2.json").write_bytes(b"\xef\xbb\xbf" + HARD[0] + b"\n")
    (tmp_path / "site_data_3_3.json").write_bytes(HARD[1])
    (tmp_path / "site_data_4_4.json").write_bytes(b'{"no":"' + b"x" * 300 + b'"}')
    raw = ds.read_raw(spark, str(tmp_path), SPEC.name_regex, "*.json", "array")
    rows = raw.orderBy("source_filename", "block_start", "line_pos").collect()
    texts = {}
    for r in rows:
        texts.setdefault(r["source_filename"], []).append(json.loads(r["text"]))
    assert texts["site_data_1_1.json"] == texts["site_data_2_2.json"] == plain(HARD[0])
    assert texts["site_data_3_3.json"] == plain(HARD[1])
    assert texts["site_data_4_4.json"] == [{"no": "x" * 300}]
    assert {r["file_bytes"] for r in rows if r["source_filename"] == "site_data_3_3.json"} == {len(HARD[1])}
    if size == 7:
        assert len({r["block_start"] for r in rows if r["source_filename"] == "site_data_1_1.json"}) > 1


def test_ingest_of_an_array_equals_that_of_its_lines(spark, tmp_path, split_at):
    split_at(5000)
    spec = replace(SPEC, provenance=True)
    documents = [document(f"o{n}", *map(str, range(n % 4)), grade='}],"\\') for n in range(300)]
    for layout, text in (("array", b"[\n" + b",\n".join(documents) + b"\n]\n"), ("lines", b"\n".join(documents))):
        folder = tmp_path / layout
        folder.mkdir()
        path = folder / "site_data_1_1.json"
        path.write_bytes(text)
        os.utime(path, (1_700_000_000, 1_700_000_000))
        tables = ds.Tables.below(str(tmp_path / f"t-{layout}"))
        audit = ds.run_incremental_ingest(spark, spec, str(folder), tables, "append", layout)
        assert audit.first()["documents"] == 300
    one, two = (ds.read_master(spark, spec, ds.Tables.below(str(tmp_path / f"t-{n}"))) for n in ("array", "lines"))
    one, two = (sorted(map(str, d.drop("INGESTION_TS").collect())) for d in (one, two))
    assert one == two and len(one) == 450


def test_bad_elements_abort_or_go_to_the_rejects(spark, tmp_path):
    (tmp_path / "site_data_1_1.json").write_bytes(b"[" + document("o", "a") + b', {"orders": 1 2}, ' + document("o", "b") + b"]")
    tables = ds.Tables.below(str(tmp_path / "t"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ds.run_incremental_ingest(spark, SPEC, str(tmp_path), tables, "append", "array")
    ds.run_incremental_ingest(spark, SPEC, str(tmp_path), tables, "append", "array", "quarantine")
    assert ds.read_master(spark, SPEC, tables).select("DOCKET_ID").orderBy("DOCKET_ID").collect() == [("a",), ("b",)]
    assert [r["text"] for r in ds.read_rejects(spark, tables).collect()] == [' {"orders": 1 2}']


def test_only_loose_ends_are_shuffled(spark, tmp_path, split_at):
    split_at(2000)
    (tmp_path / "site_data_1_1.json").write_bytes(b"[" + b",".join(document(f"o{n}", "a") for n in range(500)) + b"]")
    raw = ds.read_raw(spark, str(tmp_path), ".*", "*.json", "array")
    assert raw.count() == 500
    blocks = raw.groupBy("block_start").agg(F.count("*").alias("n"), F.max("line_pos").alias("last"))
    assert blocks.count() > 15 and blocks.where("n < last").isEmpty()


def test_delivered_arrays_are_whole_however_tasks_are_merged(spark):
    """With 16 parts to merge, a second look at the documents has them in other tasks."""
    from conftest import SF_DIR

    from docstrata import catalogue

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "60kb")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "60kb")
    try:
        rows = catalogue.QUERIES["array_ingest"](spark, SF_DIR)
        plain = catalogue.QUERIES["nested_ingest"](spark, SF_DIR)
        assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for name in ("coalescePartitions.minPartitionSize", "coalescePartitions.parallelismFirst", "advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.adaptive.{name}")


@pytest.mark.parametrize("pack", ["gzip", "bz2"])
def test_packed_arrays_are_those_of_plain_files(spark, tmp_path, pack):
    import bz2
    import gzip

    packed = {"gzip": (gzip.compress, "gz"), "bz2": (bz2.compress, "bz2")}[pack]
    bodies = [
        HARD[0],
        HARD[1] + b"\n",
        b"\xef\xbb\xbf" + HARD[0] + b"\r\n\n",
        b'{"no":"' + b"x" * 300 + b'"}',
        b"[]",
        b"",
        b"[" + b",\r\n".join(document(f"o{n}", "a", grade="},{") for n in range(500)) + b"]",
        b'[{"a": 1}]}',
        b'[{"a": 1}',
        b'[{"a": 1},\n]',
    ]
    for n, body in enumerate(bodies):
        (tmp_path / f"site_data_{n}_1.json").write_bytes(body)
        (tmp_path / f"site_data_{n}_1.json.{packed[1]}").write_bytes(packed[0](body))
    raw = ds.read_raw(spark, str(tmp_path), "^site_data", "*", "array")
    texts = {}
    for r in raw.orderBy("source_filename", "block_start", "line_pos").collect():
        # A new line may be put before the mark of a malformed end.
        texts.setdefault(r["source_filename"], []).append(r["text"].replace("\n", "").strip())
    for n, body in enumerate(bodies):
        name = f"site_data_{n}_1.json"
        assert texts.get(f"{name}.{packed[1]}") == texts.get(name), body[:40]
    assert len(texts[f"site_data_6_1.json.{packed[1]}"]) == 500


def test_delivered_arrays_are_packed(spark, monkeypatch):
    from conftest import SF_DIR

    from docstrata import catalogue

    seen = []
    read = ds.read_raw
    monkeypatch.setattr(ds, "read_raw", lambda spark, folder, *a, **o: seen.append(folder) or read(spark, folder, *a, **o))
    rows = catalogue.QUERIES["array_ingest"](spark, SF_DIR)
    plain = catalogue.QUERIES["nested_ingest"](spark, SF_DIR)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    files = [f for f in os.listdir(seen[0]) if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)
