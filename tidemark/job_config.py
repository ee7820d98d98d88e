"""Job files in the layout the reference's users already have.

A job file has ``job`` (name), ``spark`` (shuffle partitions, trigger,
retention, idle progress interval), ``kafka`` (topic, offsets, intake limit,
data format, ``schema_cdc``, ``schema_data``) and ``output`` (``sql_conditions``,
``target_table``, ``write_mode``); a shared common file has the Kafka
connection (``kafka``) and table properties (``lakehouse.iceberg``).
``spec_from_job_config`` maps both onto a ``JobSpec``; ``load_job_yaml`` does
the same from YAML text (PyYAML, when installed).  A job may also say ``kafka.envelope``
(values beside the images), ``event_time`` (watermark, windows, sessions, dedup) and, in
``output``, ``path``, ``upsert_keys``, ``upsert_order``, ``buckets``, ``evolve``,
``late_path`` and ``idempotent``.

Placeholders such as ``${VAR}`` are not expanded here: secrets and endpoints
belong to whoever launches the job, who passes finished dicts.
"""

from __future__ import annotations

from typing import Any, Mapping

from .spec import (
    DEFAULT_MIN_BATCHES_TO_RETAIN,
    DEFAULT_NO_DATA_PROGRESS_INTERVAL_MS, DEFAULT_SASL_MECHANISM, DEFAULT_SECURITY_PROTOCOL,
    DEFAULT_STARTING_OFFSETS, DEFAULT_TRIGGER, DEFAULT_WRITE_MODE, DeclaredSchema, EventTimeSpec, JobSpec,
    OutputSpec, SourceSpec, SparkSettings,
)


# Settings of this library that a job file's ``output`` may add under their own names.
_OUTPUT_EXTRAS = ("upsert_keys", "upsert_order", "buckets", "evolve", "late_path", "idempotent")


def _bool(v: Any) -> bool:
    if isinstance(v, bool):
        return v
    return str(v).strip().lower() in ("true", "1", "yes")


def _section(d: Mapping[str, Any] | None, key: str) -> Mapping[str, Any]:
    v = (d or {}).get(key)
    return v if isinstance(v, Mapping) else {}


def spec_from_job_config(job: Mapping[str, Any], common: Mapping[str, Any] | None = None, *,
                         table_format: str = "iceberg", checkpoint_root: str | None = None) -> JobSpec:
    name = _section(job, "job").get("name", "unknown_job")
    sp = _section(job, "spark")
    kj = _section(job, "kafka")
    out = _section(job, "output")
    kc = _section(common, "kafka")
    props = _section(_section(common, "lakehouse"), "iceberg")
    if checkpoint_root is None:
        bucket = str(_section(_section(common, "lakehouse"), "ceph").get("bucket_checkpoints") or "").strip(" ,/")
        if bucket:
            checkpoint_root = bucket if "://" in bucket or bucket.startswith("/") else f"s3a://{bucket}"

    data_format = str(kj.get("data_format", "json")).strip().lower()
    if data_format != "json":
        raise ValueError(f"data_format {data_format!r}: only JSON change records are read")

    spark = SparkSettings(
        shuffle_partitions=int(sp["shuffle_partitions"]) if sp.get("shuffle_partitions") else None,
        trigger_interval=str(sp.get("trigger_interval", DEFAULT_TRIGGER)),
        min_batches_to_retain=int(sp.get("min_batches_to_retain", DEFAULT_MIN_BATCHES_TO_RETAIN)),
        no_data_progress_event_interval=int(sp.get("no_data_progress_event_interval",
                                                   DEFAULT_NO_DATA_PROGRESS_INTERVAL_MS)),
        no_data_micro_batches_enabled=_bool(sp.get("no_data_micro_batches_enabled", True)),
    )
    source = SourceSpec(
        kind="kafka",
        topics=str(kj.get("topics_in", "")),
        bootstrap_servers=str(kc.get("bootstrap_servers", "")),
        starting_offsets=str(kj.get("auto_offset_reset", DEFAULT_STARTING_OFFSETS)),
        max_offsets_per_trigger=int(kj["max_offsets_per_trigger"]) if kj.get("max_offsets_per_trigger") else None,
        secure=_bool(kc.get("secure", False)),
        security_protocol=str(kc.get("security_protocol", DEFAULT_SECURITY_PROTOCOL)),
        sasl_mechanism=str(kc.get("sasl_mechanism", DEFAULT_SASL_MECHANISM)),
        user=str(kc.get("user", "")),
        password=str(kc.get("password", "")),
    )
    output = OutputSpec(
        sql=out.get("sql_conditions"),
        temp_view=kj.get("temp_view") or out.get("temp_view"),
        columns=list(out["columns"]) if out.get("columns") else None,
        target_table=str(out.get("target_table", "") or ""),
        write_mode=str(out.get("write_mode", DEFAULT_WRITE_MODE)),
        path=out.get("path"),
        format="parquet" if out.get("path") else table_format,
        table_properties={str(k): str(v) for k, v in props.items()},
        **{k: out[k] for k in _OUTPUT_EXTRAS if k in out},
    )
    return JobSpec(name=str(name), schema=DeclaredSchema.coerce(_section(kj, "schema_data")),
                   source=source, output=output, spark=spark, checkpoint_root=checkpoint_root,
                   envelope={str(k): str(v) for k, v in _section(kj, "envelope").items()},
                   event_time=EventTimeSpec.from_dict(job.get("event_time")))


def load_job_yaml(job_text: str, common_text: str | None = None, **kw) -> JobSpec:
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - depends on the environment
        raise RuntimeError("PyYAML is not installed: pass dicts to spec_from_job_config") from e
    job = yaml.safe_load(job_text) or {}
    common = yaml.safe_load(common_text) if common_text else None
    return spec_from_job_config(job, common, **kw)
