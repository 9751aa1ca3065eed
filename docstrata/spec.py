"""Declarative description of one nested-document pipeline.

Every operator that needs to know about the documents reads a
:class:`PipelineSpec`; a new pipeline is a new spec, not new code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

#: Columns the library adds next to the declared ones.  They say where a row
#: came from, so they never take part in "did the content change?".
ENGINE_COLUMNS = (
    "source_filename",
    "file_modified_at",
    "source_path",
    "block_start",
    "line_pos",
    "document_pos",
    "element_pos",
    "batch_id",
    "order_day",
    "file_name",
)

TIMESTAMP_TYPES = ("timestamp_ntz", "timestamp")


@dataclass(frozen=True)
class FieldSpec:
    """One output column.

    ``path`` is dotted and relative to the array element of ``level`` (0 is the
    root array, 1 the first nested one, ...).  ``type`` is a Spark DDL type.
    Timestamps are always parsed safely (unparsable becomes NULL); any other
    type raises on a bad value while ``strict``, else gives NULL.
    ``sentinels`` are exact texts that mean "no value"; ``assume_offset`` is
    appended to offset-less text before it is parsed.  ``format`` is how times are
    written, one of ``TIME_FORMATS``, or ``auto``: each load then reads them in the format
    that most of its values are written in.
    """

    name: str
    path: str
    type: str = "string"
    level: int = 0
    strict: bool = True
    sentinels: tuple[str, ...] = ()
    assume_offset: str | None = None
    format: str = "iso"

    @property
    def leaf_type(self) -> T.DataType:
        """Type to read the raw value as, before sentinels and time parsing."""
        as_text = self.type in TIMESTAMP_TYPES or self.sentinels
        return T.StringType() if as_text else T.DataType.fromDDL(self.type)


@dataclass(frozen=True)
class PipelineSpec:
    """Where the rows are in the document and which keys identify them.

    ``provenance`` adds file name, file time, line, and the positions of the document
    in its array and of the elements in theirs to the master.  ``day_col`` names a time
    column by whose day the master is laid out in folders.
    """

    root: str
    levels: tuple[str, ...]
    fields: tuple[FieldSpec, ...]
    natural_key: tuple[str, ...]
    view_key: tuple[str, ...]
    version_key: tuple[str, ...]
    order_col: str = "INGESTION_TS"
    exclude: tuple[str, ...] = ()
    zone: str = "Asia/Hong_Kong"
    name_regex: str = r"\.json$"
    name_glob: str = "*.json"
    provenance: bool = False
    day_col: str | None = None

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError("field names must be unique")
        deepest = max(f.level for f in self.fields)
        if deepest > len(self.levels):
            raise ValueError(f"level {deepest} is not among the nested arrays {self.levels}")
        unknown = {*self.natural_key, *self.view_key, *self.version_key} - set(names)
        if unknown:
            raise ValueError(f"keys without a field: {sorted(unknown)}")
        if self.day_col is not None and self.day_col not in names:
            raise ValueError(f"day_col {self.day_col!r} is not a field")

    def with_field(self, *fields: FieldSpec) -> PipelineSpec:
        """The same pipeline with more columns (schema evolution)."""
        return replace(self, fields=self.fields + fields)

    def at_level(self, level: int) -> list[FieldSpec]:
        return [f for f in self.fields if f.level == level]

    @property
    def untracked(self) -> tuple[str, ...]:
        """Columns that are not content: version key, stamp, engine columns."""
        return (*self.version_key, self.order_col, *self.exclude, *ENGINE_COLUMNS)

    def master_schema(self) -> T.StructType:
        """Typed schema of the master table, in declared order."""
        schema = T.StructType()
        for f in self.fields:
            schema = schema.add(f.name, T.DataType.fromDDL(f.type), True)
        schema = schema.add(self.order_col, T.TimestampNTZType(), False)
        if self.provenance:
            schema = (
                schema.add("source_filename", T.StringType())
                .add("file_modified_at", T.TimestampNTZType())
                .add("line_pos", T.LongType())
                .add("document_pos", T.IntegerType())
                .add("element_pos", T.ArrayType(T.IntegerType(), False))
            )
        return schema

    def document_type(self) -> T.ArrayType:
        """Schema for reading the root array, leaves as :meth:`read_type` says."""
        element: T.StructType | None = None
        for level in range(len(self.levels), -1, -1):
            tree: dict = {}
            for f in self.at_level(level):
                _plant(tree, f.path.split("."), self.read_type(f))
            if element is not None:
                _plant(tree, self.levels[level].split("."), T.ArrayType(element))
            element = _as_struct(tree)
        return T.ArrayType(element)

    def read_type(self, field: FieldSpec) -> T.DataType:
        """Text where that is all a path is read as; other leaves stay semi-structured, so
        that one cast decides over them, whichever way the document was parsed."""
        kinds = {f.leaf_type for f in self.at_level(field.level) if f.path == field.path}
        return T.StringType() if kinds == {T.StringType()} else T.VariantType()


def _plant(tree: dict, path: Sequence[str], leaf: T.DataType) -> None:
    *parents, last = path
    for name in parents:
        tree = tree.setdefault(name, {})
    tree[last] = leaf


def _as_struct(tree: dict) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, _as_struct(node) if isinstance(node, dict) else node)
            for name, node in tree.items()
        ]
    )


# --- the delivery-docket pipeline ------------------------------------------

# The text that stands for "has not happened yet", the local
# offset of the documents, and the three ways the document times are read.
NOT_YET = "1900-01-01T00:00:00"
LOCAL_OFFSET = "+08:00"
CLEANED_TIMES = {
    "setup": ("startDischargeTime", "finishDischargeTime"),
    "daily": ("siteArrivalTime", "startDischargeTime", "finishDischargeTime"),
    "offset": ("startDischargeTime", "finishDischargeTime"),
}

# Output column, path in the order or docket object, type.
ORDER_COLUMNS = (
    ("PROJECT_ID", "projectId", "string"),
    ("ORDER_ID", "orderId", "string"),
    ("LINE_ID", "lineId", "string"),
    ("ORDER_QUANTITY", "quantity", "decimal(18,6)"),
    ("SITE_LAT", "siteAddress.lat", "decimal(18,9)"),
    ("SITE_LNG", "siteAddress.lng", "decimal(18,9)"),
    ("SITE_ID", "siteAddress.siteId", "string"),
    ("SITE_NAME", "siteAddress.siteName", "string"),
    ("DOCKET_COUNT", "docketCount", "decimal(38,0)"),
)
DOCKET_COLUMNS = (
    ("DOCKET_ID", "docketId", "string"),
    ("ORDER_DATE", "orderDate", "timestamp_ntz"),
    ("LOCATION", "location", "string"),
    ("CONCRETE_GRADE", "concreteGrade", "string"),
    ("MIX_ID", "mixId", "string"),
    ("TRUCK_NUMBER", "truckNumber", "string"),
    ("FLEET_NUMBER", "fleetNumber", "string"),
    ("DELIVERY_QUANTITY", "deliveryQuantity", "decimal(18,6)"),
    ("LOADED_TIME", "loadedTime", "timestamp_ntz"),
    ("SITE_ARRIVAL_TIME", "siteArrivalTime", "timestamp_ntz"),
    ("START_DISCHARGE_TIME", "startDischargeTime", "timestamp_ntz"),
    ("FINISH_DISCHARGE_TIME", "finishDischargeTime", "timestamp_ntz"),
    ("COMPLIANCE", "compliance", "string"),
    ("SITE_CONTACT", "siteContact", "string"),
    ("GRADE", "grade", "string"),
    ("RATIO_OPC", "ratioOPC", "decimal(38,0)"),
    ("RATIO_PFA", "ratioPFA", "decimal(38,0)"),
    ("RATIO_GGBS", "ratioGGBS", "decimal(38,0)"),
    ("RATIO_CSF", "ratioCSF", "decimal(38,0)"),
    ("PLANT_NAME", "plantName", "string"),
    ("CUM_TOTAL", "cumTotal", "decimal(18,6)"),
    ("CUSTOMER_ORDER_ID", "customerOrderID", "string"),
)


def delivery_spec(times: str = "daily", file_prefix: str = r"[^_/]+_[^_/]+") -> PipelineSpec:
    """Spec of the docket pipeline: ``{"orders": [{..., "dockets": [{...}]}]}``.

    ``times`` picks how document times are read: ``setup`` and ``daily`` differ
    in whether an arrival time may be the "not yet" text, ``offset`` reads the
    text as carrying the local offset.  Files are named
    ``<file_prefix>_<part>_<part>.json``.
    """
    cleaned = CLEANED_TIMES[times]
    offset = LOCAL_OFFSET if times == "offset" else None

    def docket(name: str, path: str, kind: str) -> FieldSpec:
        if kind != "timestamp_ntz":
            return FieldSpec(name, path, kind, level=1)
        return FieldSpec(
            name,
            path,
            kind,
            level=1,
            sentinels=(NOT_YET,) if path in cleaned else (),
            assume_offset=offset,
        )

    return PipelineSpec(
        root="orders",
        levels=("dockets",),
        fields=(
            *(FieldSpec(*c) for c in ORDER_COLUMNS),
            *(docket(*c) for c in DOCKET_COLUMNS),
        ),
        natural_key=("ORDER_ID", "LINE_ID", "DOCKET_ID"),
        view_key=("DOCKET_ID", "PROJECT_ID", "ORDER_ID"),
        version_key=("DOCKET_ID",),
        name_regex=rf"^{file_prefix}_[^_/]+_[^_/]+\.json$",
    )
