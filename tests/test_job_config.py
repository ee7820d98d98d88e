"""Job files in the reference's layout map onto a JobSpec."""

import pytest

from tidemark import kafka_options
from tidemark.job_config import load_job_yaml, spec_from_job_config

JOB_YAML = """
job:
  name: orders_feed
spark:
  shuffle_partitions: 48
  trigger_interval: "30 seconds"
  min_batches_to_retain: 20
kafka:
  topics_in: shop.orders
  auto_offset_reset: earliest
  max_offsets_per_trigger: 250000
  data_format: json
  temp_view: orders_now
  schema_data:
    fields:
      - {name: o_orderkey, type: long}
      - {name: o_totalprice, type: double}
      - {name: o_orderdate, type: timestamp}
      - {name: note, type: string}
output:
  sql_conditions: >
    select o_orderkey, o_totalprice, op from orders_now where o_totalprice > 10
  columns: [o_orderkey, op]
  target_table: sales.orders
"""

COMMON_YAML = """
lakehouse:
  ceph:
    bucket_checkpoints: stream-state
  iceberg:
    write.parquet.compression-codec: snappy
kafka:
  bootstrap_servers: k1:9093,k2:9093
  user: reader
  password: hidden
  security_protocol: SASL_SSL
  sasl_mechanism: SCRAM-SHA-512
  secure: true
"""


def test_load_job_yaml():
    spec = load_job_yaml(JOB_YAML, COMMON_YAML)
    assert spec.name == "orders_feed" and spec.view_name == "orders_now"
    assert spec.schema.names == ["o_orderkey", "o_totalprice", "o_orderdate", "note"]
    assert spec.output.sql.strip().startswith("select o_orderkey") and spec.output.columns == ["o_orderkey", "op"]
    assert spec.output.target_table == "sales.orders" and spec.output.format == "iceberg"
    assert spec.output.table_properties == {"write.parquet.compression-codec": "snappy"}
    assert spec.spark.trigger_interval == "30 seconds" and spec.spark.shuffle_partitions == 48
    opts = kafka_options(spec.source)
    assert opts["subscribe"] == "shop.orders" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "250000" and "SCRAM-SHA-512" == opts["kafka.sasl.mechanism"]


def test_checkpoints_go_to_the_bucket_of_the_common_file():
    assert load_job_yaml(JOB_YAML, COMMON_YAML).checkpoint_root == "s3a://stream-state"
    assert load_job_yaml(JOB_YAML, COMMON_YAML, checkpoint_root="/x").checkpoint_root == "/x"
    assert load_job_yaml(JOB_YAML).checkpoint_root is None


def test_no_intake_limit_unless_stated():
    spec = spec_from_job_config({"kafka": {"topics_in": "t"}}, {"kafka": {"bootstrap_servers": "b:1"}})
    assert "maxOffsetsPerTrigger" not in kafka_options(spec.source)


def test_avro_is_refused():
    with pytest.raises(ValueError):
        spec_from_job_config({"kafka": {"data_format": "avro"}})


def test_parsed_rows_of_the_job(spark):
    from tidemark import parse_changes
    spec = load_job_yaml(JOB_YAML, table_format="parquet")
    df = spark.createDataFrame([('{"after":{"o_orderkey":7,"o_totalprice":"12.5","note":3.0},"op":"u"}',)],
                               "value string")
    assert [(r.o_orderkey, r.o_totalprice, r.note, r.op) for r in parse_changes(df, spec.schema).collect()] == [
        (7, 12.5, "3.0", "u")]


def test_stateful_settings_of_a_job_file():
    spec = spec_from_job_config({
        "job": {"name": "keeper"},
        "kafka": {"topics_in": "t", "schema_data": {"fields": [{"name": "id", "type": "long"}]},
                  "envelope": {"ts_ms": "bigint", "source.lsn": "bigint"}},
        "event_time": {"column": "ts_ms", "delay": "10 minutes", "dedup": ["id"]},
        "output": {"path": "/t", "upsert_keys": ["id"], "upsert_order": ["ts_ms", "lsn"], "buckets": 256}})
    assert spec.envelope == {"ts_ms": "bigint", "source.lsn": "bigint"}
    assert spec.event_time.stateful and spec.event_time.delay == "10 minutes"
    assert (spec.output.path, spec.output.format, spec.output.upsert_keys, spec.output.buckets) == ("/t", "parquet", ["id"], 256)
    plain = spec_from_job_config({"job": {"name": "x"}})
    assert plain.event_time is None and plain.envelope == {} and plain.output.format == "iceberg"
