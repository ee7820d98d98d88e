"""Declared schemas and the declarative job spec.

A job is plain data: which change stream to read, which fields to cast the
row images to, which SQL to run on every micro-batch and where to write the
result.  Everything here runs on the driver and only builds names and types;
no data passes through it.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields as dc_fields
from typing import Any, Mapping

from pyspark.sql import types as T

# Declared type names and the Spark type each one maps to.
# Names are trimmed and lower-cased first; any other name means string.
# "struct" keeps the nested value as JSON text.
TYPE_NAMES: dict[str, str] = {
    "string": "string",
    "str": "string",
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bigint": "bigint",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "bool": "boolean",
    "timestamp": "timestamp",
    "date": "date",
    "struct": "string",
}

_SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

OP_COLUMN = "op"


def spark_type_name(declared: Any) -> str:
    """Declared type name -> Spark SQL type name (unknown or absent -> string)."""
    if declared is None:
        return "string"
    return TYPE_NAMES.get(str(declared).strip().lower(), "string")


@dataclass(frozen=True)
class DeclaredField:
    name: str
    type: str = "string"

    @property
    def sql_type(self) -> str:
        return spark_type_name(self.type)

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.sql_type]


@dataclass(frozen=True)
class DeclaredSchema:
    """An ordered list of declared ``{name, type}`` fields."""

    fields: tuple[DeclaredField, ...] = ()

    @classmethod
    def coerce(cls, schema: Any) -> "DeclaredSchema":
        """Accept a DeclaredSchema, a list of dicts (``name`` or ``field`` key),
        a ``{"fields": [...]}`` dict, a list of ``(name, type)`` pairs or a
        ``{name: type}`` mapping."""
        if isinstance(schema, DeclaredSchema):
            return schema
        if isinstance(schema, Mapping) and "fields" in schema:
            schema = schema["fields"] or []
        if isinstance(schema, Mapping):
            return cls(tuple(DeclaredField(str(k), v) for k, v in schema.items()))
        out = []
        for item in schema or []:
            if isinstance(item, DeclaredField):
                out.append(item)
            elif isinstance(item, Mapping):
                name = item.get("name", item.get("field"))
                if not name:
                    raise ValueError(f"declared field without a name: {dict(item)!r}")
                out.append(DeclaredField(str(name), item.get("type", "string")))
            else:
                name, typ = item
                out.append(DeclaredField(str(name), typ))
        return cls(tuple(out))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def to_field_map(self) -> dict[str, str]:
        """name -> declared type; the last duplicate wins."""
        return {f.name: f.type for f in self.fields}

    def struct_type(self, with_op: bool = False) -> T.StructType:
        st = T.StructType([T.StructField(f.name, f.spark_type, True) for f in self.fields])
        if with_op:
            st = st.add(OP_COLUMN, T.StringType(), True)
        return st

    def check_parse_target(self) -> None:
        """A parsed change row is the declared fields followed by ``op``."""
        names = self.names
        if OP_COLUMN in names:
            raise ValueError("a declared field may not be named 'op': the parse adds it")
        dup = {n for n in names if names.count(n) > 1}
        if dup:
            raise ValueError(f"duplicate declared fields: {sorted(dup)}")


def field_map(items: list[Mapping[str, Any]]) -> dict[str, str]:
    """``[{field, type}]`` -> ``{field: type}``; entries without a name are skipped."""
    out: dict[str, str] = {}
    for item in items or []:
        name = item.get("field", item.get("name"))
        if name:
            out[str(name)] = item.get("type", "string")
    return out


def _from_mapping(cls, data: Mapping[str, Any] | None):
    if data is None:
        return cls()
    if isinstance(data, cls):
        return data
    known = {f.name for f in dc_fields(cls)}
    unknown = set(data) - known
    if unknown:
        raise ValueError(f"{cls.__name__}: unknown keys {sorted(unknown)}")
    return cls(**dict(data))


# Defaults of a job (trigger, retention, idle progress interval,
# intake limit, starting offsets, write mode, catalog and namespace of the
# target table, console preview rows, Kafka security protocol and mechanism).
DEFAULT_TRIGGER = "1 seconds"
DEFAULT_MIN_BATCHES_TO_RETAIN = 5
DEFAULT_NO_DATA_PROGRESS_INTERVAL_MS = 100000
DEFAULT_STARTING_OFFSETS = "latest"
DEFAULT_WRITE_MODE = "append"
DEFAULT_CATALOG = "bronze"
DEFAULT_NAMESPACE = "bronze"
DEFAULT_CONSOLE_ROWS = 20
DEFAULT_SECURITY_PROTOCOL = "SASL_PLAINTEXT"
DEFAULT_SASL_MECHANISM = "SCRAM-SHA-256"


@dataclass
class SparkSettings:
    # None leaves the session's shuffle-partition count alone: a fixed small
    # count would starve per-batch joins and aggregates on a large cluster
    # (AQE coalesces a generous count down to the data).
    shuffle_partitions: int | None = None
    trigger_interval: str = DEFAULT_TRIGGER
    min_batches_to_retain: int = DEFAULT_MIN_BATCHES_TO_RETAIN
    no_data_progress_event_interval: int = DEFAULT_NO_DATA_PROGRESS_INTERVAL_MS
    no_data_micro_batches_enabled: bool = True
    extra_conf: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d):
        return _from_mapping(cls, d)


@dataclass
class SourceSpec:
    """Where change records come from.

    ``kind="kafka"`` subscribes to ``topics`` (comma list); ``kind="files"``
    reads JSON text files (one record per line) under ``path``.
    """

    kind: str = "kafka"
    topics: str = ""
    bootstrap_servers: str = ""
    starting_offsets: str = DEFAULT_STARTING_OFFSETS
    max_offsets_per_trigger: int | None = None      # no limit unless the job states one
    min_partitions: int | None = None
    secure: bool = False
    security_protocol: str = DEFAULT_SECURITY_PROTOCOL
    sasl_mechanism: str = DEFAULT_SASL_MECHANISM
    user: str = ""
    password: str = ""
    path: str = ""
    max_files_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)
    # source columns carried in front of the parsed ones, e.g. Kafka's
    # ["key", "partition", "offset", "timestamp"] for per-batch dedup by offset
    keep_columns: list[str] = field(default_factory=list)

    @classmethod
    def from_dict(cls, d):
        return _from_mapping(cls, d)

    def __repr__(self) -> str:  # never show the secret
        return (f"SourceSpec(kind={self.kind!r}, topics={self.topics!r}, path={self.path!r}, "
                f"secure={self.secure}, password={'***' if self.password else ''!r})")


@dataclass
class EventTimeSpec:
    """Event time of a job's changes and what is done with it (``operators.event_time``).

    ``column`` is a timestamp field, or epoch milliseconds (an ``envelope`` value such
    as ``ts_ms``); ``delay`` is how far rows may be behind the greatest one seen.
    Either ``window`` (with ``slide``) or ``session_gap`` groups by ``keys``;
    ``aggregates`` are SQL expressions by name.  ``dedup`` names the columns of which
    each value passes once within the delay.
    """

    column: str = "ts_ms"
    delay: str = "0 seconds"
    dedup: list[str] = field(default_factory=list)
    window: str | None = None
    slide: str | None = None
    session_gap: str | None = None
    keys: list[str] = field(default_factory=list)
    aggregates: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d):
        return None if d is None else _from_mapping(cls, d)

    @property
    def stateful(self) -> bool:
        return bool(self.dedup or self.window or self.session_gap)


@dataclass
class OutputSpec:
    """What to run on each micro-batch and where the result goes.

    ``sink`` is ``table`` (catalog table, name resolved from ``target_table``),
    ``path`` (files under ``path``) or ``console``.  With ``upsert_keys`` the changes
    are merged into the current-state table at ``path`` (``sinks.current``): per key
    the greatest ``upsert_order`` wins, deletes remove.  ``evolve`` lets the table at
    ``path`` gain and widen columns (``sinks.evolve``).  ``late_path`` takes the rows
    behind the watermark of the job's ``event_time``.
    """

    sql: str | None = None
    temp_view: str | None = None
    columns: list[str] | None = None
    sink: str = "table"
    target_table: str = ""
    path: str | None = None
    format: str = "parquet"
    write_mode: str = DEFAULT_WRITE_MODE
    options: dict[str, str] = field(default_factory=dict)
    table_properties: dict[str, str] = field(default_factory=dict)
    distribute_by: list[str] | None = None
    idempotent: bool = False
    upsert_keys: list[str] = field(default_factory=list)
    upsert_order: list[str] = field(default_factory=lambda: ["ts_ms"])
    buckets: int = 64
    evolve: bool = False
    late_path: str | None = None
    console_rows: int = DEFAULT_CONSOLE_ROWS

    @classmethod
    def from_dict(cls, d):
        return _from_mapping(cls, d)


@dataclass
class JobSpec:
    name: str = "unknown_job"
    schema: DeclaredSchema = field(default_factory=DeclaredSchema)
    source: SourceSpec = field(default_factory=SourceSpec)
    output: OutputSpec = field(default_factory=OutputSpec)
    spark: SparkSettings = field(default_factory=SparkSettings)
    # SQL functions the job's SQL may call: {name: "(p STRING) RETURNS STRING RETURN ..."}
    functions: dict[str, str] = field(default_factory=dict)
    # Static tables the job's SQL may join: {view name: parquet path or table name}
    lookup_tables: dict[str, str] = field(default_factory=dict)
    # Keep only changes with these operations (decided within the parse); empty: all.
    operations: list[str] = field(default_factory=list)
    # Values beside the images to carry on, e.g. {"ts_ms": "bigint", "source.pos": "bigint"}.
    envelope: dict[str, str] = field(default_factory=dict)
    event_time: EventTimeSpec | None = None
    checkpoint_root: str | None = None
    checkpoint_location: str | None = None
    catalog: str = DEFAULT_CATALOG
    namespace: str = DEFAULT_NAMESPACE
    phone_country_code: str | None = None

    @property
    def view_name(self) -> str:
        return self.output.temp_view or self.name

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> "JobSpec":
        d = dict(d or {})
        job = d.pop("job", None)
        if isinstance(job, Mapping):
            d.setdefault("name", job.get("name", "unknown_job"))
        return cls(
            name=d.pop("name", "unknown_job"),
            schema=DeclaredSchema.coerce(d.pop("schema", [])),
            source=SourceSpec.from_dict(d.pop("source", None)),
            output=OutputSpec.from_dict(d.pop("output", None)),
            event_time=EventTimeSpec.from_dict(d.pop("event_time", None)),
            spark=SparkSettings.from_dict(d.pop("spark", None)),
            **d,
        )
