"""From raw texts to documents and flat rows.

Two routes give the same rows.  ``typed`` parses each document once against the
structure the spec declares and only materialises the declared leaves.  ``variant``
keeps the whole semi-structured value, for paths nobody declared in advance.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docstrata.functions.extract import final_value, leaf_value, path_value
from docstrata.functions.times import AUTO, detect_formats
from docstrata.operators.flatten import flatten
from docstrata.sources.files import read_raw
from docstrata.spec import TIMESTAMP_TYPES, FieldSpec, PipelineSpec

ON_ERROR = ("abort", "quarantine")
ENGINES = ("typed", "variant")
_CORRUPT = "_corrupt"
_END = "_end"


def _clean(text: Column) -> Column:
    """Without a byte order mark."""
    return F.when(text.startswith("\ufeff"), F.substring(text, 2, (1 << 31) - 1)).otherwise(text)


def _wrapped(text: Column, mark: Column) -> Column:
    """The text as an object: its documents as the array ``d``, and a mark after them.

    A single document gets brackets.  Readers stop after the first complete value;
    if the text holds more than one, the mark, which no text can hold, is not read.
    """
    body = F.when(text.rlike(r"^[ \t\r\n]*\["), text).otherwise(
        F.concat(F.lit("["), text, F.lit("]"))
    )
    return F.concat(F.lit('{"d":'), body, F.lit(f',"{_END}":"'), mark, F.lit('"}'))


def _variant_documents(text: Column, on_error: str) -> Column:
    """The array of documents of a text as a variant.

    Text that is not JSON, that goes on after its documents or has one that is neither
    an object nor null, raises, or gives NULL under ``quarantine``.
    """
    text = _clean(text)
    parsed = (F.parse_json if on_error == "abort" else F.try_parse_json)(_wrapped(text, F.md5(text)))

    def checked(value: Column) -> Column:
        whole = F.try_variant_get(value, f"$.{_END}", "string") == F.md5(text)
        items = F.try_variant_get(value, "$.d", "array<variant>")
        objects = F.forall(
            items,
            lambda i: F.is_variant_null(i) | F.try_variant_get(i, "$", "struct<>").isNotNull(),
        )
        good = F.coalesce(whole & objects, F.lit(False))
        return F.when(good, F.variant_get(value, "$.d", "variant"))

    # As the argument of a function the parse is run once, wherever the result is used.
    documents = F.transform(F.array(parsed), checked)[0]
    if on_error == "abort":
        message = F.concat(F.lit("MALFORMED_RECORD: not a document or array of documents: "), F.left(text, F.lit(200)))
        raised = F.when(text.isNotNull(), F.raise_error(message).cast("variant"))
        documents = F.coalesce(documents, raised)
    return documents


def parse_documents(raw: DataFrame, root: str, on_error: str = "abort") -> DataFrame:
    """Landing rows: one per document, with the ``root`` field as a variant.

    A top-level array gives one row per element.  Documents without the root
    field give no row.  ``abort`` raises on malformed text; ``quarantine``
    leaves it out, see :func:`rejected_documents`.
    """
    _check(on_error, ON_ERROR)
    documents = _variant_documents(F.col("text"), on_error)
    rows = flatten(
        raw.withColumn("_documents", documents).drop("text"), "_documents", "_document"
    )
    kept = [c for c in raw.columns if c != "text"]
    payload = F.variant_get("_document", f"$.{root}", "variant")
    return (
        rows.select(*kept, F.col("_document_pos").alias("document_pos"), payload.alias("payload"))
        .where(F.col("payload").isNotNull())
    )


def load_documents(
    spark: SparkSession,
    directory: str,
    root: str,
    name_regex: str = ".*",
    name_glob: str = "*",
    layout: str = "document",
    on_error: str = "abort",
    recursive: bool = False,
) -> DataFrame:
    """Bulk load of many files into landing rows (see :func:`parse_documents`)."""
    raw = read_raw(spark, directory, name_regex, name_glob, layout, recursive)
    return parse_documents(raw, root, on_error)


def rejected_documents(raw: DataFrame) -> DataFrame:
    """The raw rows whose text is not one JSON object (or array of them)."""
    documents = _variant_documents(F.col("text"), "quarantine")
    # As the output of a generator: a filter on the parse itself is pushed below what the
    # text is made of, which is then made anew at every mention of it.
    found = F.explode(F.array(F.col("text").isNull() | documents.isNull())).alias("_rejected")
    return raw.select("*", found).where("_rejected").drop("_rejected")


def flatten_documents(
    raw: DataFrame, spec: PipelineSpec, on_error: str = "abort", engine: str = "typed"
) -> DataFrame:
    """Raw texts to one typed row per innermost array element.

    Keeps ``source_filename`` and ``file_modified_at`` and adds ``document_pos``.
    Levels are inner: an element with an empty, missing or null nested array
    gives no row.  Each level's columns are extracted before the next level is
    opened, so a row never carries its siblings along.
    """
    _check(on_error, ON_ERROR)
    _check(engine, ENGINES)
    if engine == "variant":
        landing = parse_documents(raw, spec.root, on_error)
        return _flatten_variant(landing, fixed_formats(lambda s: _flatten_variant(landing, s), spec))
    parsed = parsed_texts(raw, spec, on_error).drop("text")
    return rows_of_parsed(parsed, fixed_formats(lambda s: rows_of_parsed(parsed, s), spec))


def fixed_formats(flat: Callable[[PipelineSpec], DataFrame], spec: PipelineSpec) -> PipelineSpec:
    """The spec with a format in place of every ``auto``; ``flat`` gives the rows of the
    load under a spec.  One more pass over the load, only where something is to be found."""
    open_ = _open_names(spec)
    if not open_:
        return spec
    found = detect_formats(flat(with_open_texts(spec)), open_)
    fields = (replace(f, format=found[f.name]) if f.name in found else f for f in spec.fields)
    return replace(spec, fields=tuple(fields))


def _open_names(spec: PipelineSpec) -> list[str]:
    return [f.name for f in spec.fields if f.format == AUTO and f.type in TIMESTAMP_TYPES]


def with_open_texts(spec: PipelineSpec) -> PipelineSpec:
    """The spec with times whose format is still to be found as texts."""
    open_ = _open_names(spec)
    fields = (replace(f, type="string", format="iso") if f.name in open_ else f for f in spec.fields)
    return replace(spec, fields=tuple(fields)) if open_ else spec


def parsed_texts(raw: DataFrame, spec: PipelineSpec, on_error: str = "abort") -> DataFrame:
    """Adds ``_docs``, the typed documents of a text.

    A malformed text raises, or gives NULL under ``quarantine``; no text, no
    documents.

    Leaves that the spec reads as text are texts, which costs less than a variant each,
    others are variants. A document that has an odd leaf (a fraction or an object where
    text is declared), or whose structure disagrees with the spec anywhere (a scalar where
    an array is declared: the schema reader gives up on everything around the odd spot),
    is read again through its variant.
    """
    documents = T.ArrayType(T.StructType([T.StructField(spec.root, spec.document_type())]))
    schema = (
        T.StructType()
        .add("d", documents)
        .add(_END, T.StringType())
        .add(_CORRUPT, T.StringType())
    )
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    text, mark, parsed = F.col("_text"), F.col("_mark"), F.col("_parsed")
    good = parsed[_CORRUPT].isNull() & (parsed[_END] == mark)
    good = good & ~_ambiguous(parsed["d"], spec)
    odd = _typed_variant(_variant_documents(F.col("text"), on_error), "$", documents)
    docs = F.when(F.col("_good"), parsed["d"]).otherwise(odd)
    # Columns of their own: what the reader is called with is made anew at every mention.
    return (
        raw.withColumn("_text", _clean(F.col("text")))
        .withColumn("_mark", F.md5(text))
        .withColumn("_parsed", F.from_json(_wrapped(text, mark), schema, options))
        .withColumn("_good", good)
        .withColumn("_docs", docs)
        .drop("_text", "_mark", "_parsed", "_good")
    )


# Leaves, each behind a new line, that need not be what their variants are as text: an object,
# an array, a number other than a whole one of up to 18 digits (the reader quotes infinity).
_NO_TEXT = r'\n(?:["\[{]|-?+\d++[.eE]|-?+\d{19})'


def _ambiguous(docs: Column, spec: PipelineSpec) -> Column:
    """Whether parsed documents have a leaf whose text does not settle its value.

    The elements of a level are one array, of which the leaves are taken path by path; all
    are looked at once. Where only ISO times count they are left out, as no number and no
    object is one.
    """

    def below(arrays: Column) -> Column:
        return F.flatten(F.array_compact(arrays))

    elements, texts = below(docs.getField(spec.root)), []
    for level in range(len(spec.levels) + 1):
        fields = spec.at_level(level)
        for path in dict.fromkeys(f.path for f in fields):
            readers = [f for f in fields if f.path == path]
            iso = all(f.type in TIMESTAMP_TYPES and f.format == "iso" for f in readers)
            if isinstance(spec.read_type(readers[0]), T.StringType) and not iso:
                texts.append(_at(elements, path.split(".")))
        if level < len(spec.levels):
            elements = below(_at(elements, spec.levels[level].split(".")))
    return F.concat_ws("\n", F.lit(""), *texts).rlike(_NO_TEXT)


def _typed_variant(value: Column, path: str, kind: T.DataType) -> Column:
    """The value at ``path`` in the declared shape; structure that differs is NULL."""
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, path, "array<variant>")
        return F.transform(items, lambda item: _typed_variant(item, "$", kind.elementType))
    if isinstance(kind, T.StructType):
        return F.struct(
            *(_typed_variant(value, f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind)
        )
    return F.variant_get(value, path, kind.simpleString())


def rows_of_parsed(parsed: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Flat typed rows from the ``_docs`` column of :func:`parsed_texts`."""
    kept = [c for c in parsed.columns if c != "_docs"]
    # The outer form, as the inner one has the optimizer add a filter on the
    # array below the parse, which then parses every document a second time.
    rows = parsed.select(*kept, F.posexplode_outer("_docs").alias("document_pos", "_document"))
    rows = rows.where(F.col("document_pos").isNotNull())
    kept.append("document_pos")
    rows = rows.select(*kept, F.posexplode(F.col("_document")[spec.root]).alias("_p0", "_e0"))
    return _ordered(_opened(rows, kept, spec, F.posexplode), spec)


def _opened(rows: DataFrame, kept: list[str], spec: PipelineSpec, explode: Callable, where: Column | None = None) -> DataFrame:
    """Level by level from the elements ``_e0`` of the root array: the columns of a level,
    then the next one. Of the innermost elements ``where`` are taken."""
    kept = list(kept)
    for level in range(len(spec.levels) + 1):
        fields = spec.at_level(level)
        element = F.col(f"_e{level}")
        kept.append(f"_p{level}")
        if where is not None and level == len(spec.levels):
            rows = rows.where(where)
        done = [_value(_leaf(element, f), f, spec.read_type(f)).alias(f.name) for f in fields]
        nested = []
        if level < len(spec.levels):
            nested = [_at(element, spec.levels[level].split(".")).alias("_nested")]
        rows = rows.select(*kept, *done, *nested)
        kept += [f.name for f in fields]
        if nested:
            deeper = explode("_nested").alias(f"_p{level + 1}", f"_e{level + 1}")
            rows = rows.select(*kept, deeper)
    return rows


def landing_rows(parsed: DataFrame, spec: PipelineSpec) -> DataFrame:
    """What the landing table holds: the flat typed rows of :func:`parsed_texts`, and one
    row for each text that gives none.

    The first row of a text has ``_documents``, how many it holds (NULL: not a document),
    and is marked by ``_first``; ``_row`` says whether it is a row of the pipeline.
    """
    kept = [c for c in parsed.columns if c != "_docs"] + ["_documents"]
    # Counted first: the generator would carry all documents along with each of them.
    rows = parsed.withColumn("_documents", F.size("_docs"))
    rows = rows.select(*kept, F.posexplode_outer("_docs").alias("document_pos", "_document"))
    kept.append("document_pos")
    rows = rows.select(*kept, F.posexplode_outer(F.col("_document")[spec.root]).alias("_p0", "_e0"))
    places = _places(spec)
    first = F.coalesce(F.greatest("document_pos", *places), F.lit(0)) == 0
    whole = F.col(places[-1]).isNotNull()
    rows = _opened(rows, kept, spec, F.posexplode_outer, first | whole)
    return rows.withColumns(
        {"_first": first, "_row": whole, "_documents": F.when(first, F.col("_documents"))}
    )


def rows_of_landing(landed: DataFrame, read: PipelineSpec, spec: PipelineSpec | None = None) -> DataFrame:
    """The flat typed rows of :func:`landing_rows`, written under the spec ``read``; times
    that it has as texts become times as ``spec`` says."""
    rows = landed.where("_row").drop("_first", "_row", "_documents")
    stored = {f.name: f for f in read.fields}
    texts = {f.name: f for f in (spec or read).fields if f != stored[f.name]}
    if texts:
        rows = rows.withColumns({n: final_value(F.col(n), f) for n, f in texts.items()})
    return _ordered(rows, read)


def _flatten_variant(landing: DataFrame, spec: PipelineSpec) -> DataFrame:
    kept = [c for c in landing.columns if c != "payload"]
    rows = flatten(landing, "payload", "_e0").withColumnRenamed("_e0_pos", "_p0")
    for level in range(len(spec.levels) + 1):
        fields = spec.at_level(level)
        element = F.col(f"_e{level}")
        kept.append(f"_p{level}")
        done = [path_value(element, f).alias(f.name) for f in fields]
        if level < len(spec.levels):
            nested = F.variant_get(element, "$." + spec.levels[level], "variant")
            rows = rows.select(*kept, *done, nested.alias("_nested"))
            rows = flatten(rows, "_nested", f"_e{level + 1}")
            rows = rows.withColumnRenamed(f"_e{level + 1}_pos", f"_p{level + 1}")
        else:
            rows = rows.select(*kept, *done)
        kept += [f.name for f in fields]
    return _ordered(rows, spec)


def _ordered(rows: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Origin first, with the positions of the elements as one column, then the fields."""
    places = _places(spec)
    declared = {f.name for f in spec.fields}
    origin = [c for c in rows.columns if c not in declared and c not in places]
    place = F.array(*(F.coalesce(p, F.lit(0)) for p in places)).alias("element_pos")
    return rows.select(*origin, place, *(f.name for f in spec.fields))


def _places(spec: PipelineSpec) -> list[str]:
    return [f"_p{level}" for level in range(len(spec.levels) + 1)]


def _value(leaf: Column, field: FieldSpec, kind: T.DataType) -> Column:
    """The value of ``field`` from its leaf as :func:`parsed_texts` gives it."""
    return leaf_value(leaf, field) if isinstance(kind, T.VariantType) else final_value(leaf, field)


def _leaf(element: Column, field: FieldSpec) -> Column:
    return _at(element, field.path.split("."))


def _at(element: Column, path: Sequence[str]) -> Column:
    for name in path:
        element = element.getField(name)
    return element


def _check(value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{value!r} is not one of {allowed}")
