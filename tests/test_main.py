"""The job launcher: placeholders from the environment, files in place of Kafka."""

import json
import time

import pytest

from tidemark.__main__ import build_spec, expand, main, parser

JOB = """
job:
  name: part_feed
spark:
  trigger_interval: "5 seconds"
kafka:
  topics_in: part_feed
  auto_offset_reset: latest
  max_offsets_per_trigger: 50000
  data_format: json
  schema_data:
    fields:
      - {name: p_brand, type: string}
      - {name: p_name, type: string}
output:
  sql_conditions: select * from part_feed where op <> 'd'
  target_table: ${TARGET_NS:-launcher_ns}.part_feed
"""

COMMON = """
kafka:
  bootstrap_servers: ${BROKERS}
  secure: false
"""


def test_expand():
    env = {"A": "1"}
    assert expand("${A}/${B:-two}/${C:-}", env) == "1/two/"
    with pytest.raises(ValueError, match="no value for C, D"):
        expand("${A}/${D}/${C}", env)
    assert expand("plain $A text", env) == "plain $A text"


def test_build_spec_from_files(tmp_path, monkeypatch):
    monkeypatch.setenv("BROKERS", "b1:9092")
    (tmp_path / "job.yaml").write_text(JOB)
    (tmp_path / "common.yaml").write_text(COMMON)
    args = parser().parse_args(["--job", str(tmp_path / "job.yaml"), "--common", str(tmp_path / "common.yaml")])
    spec = build_spec(args)
    assert spec.source.bootstrap_servers == "b1:9092" and spec.source.kind == "kafka"
    assert spec.output.target_table == "launcher_ns.part_feed"


def test_main_runs_a_job_over_files(spark, tmp_path, caplog):
    caplog.set_level("INFO", logger="tidemark.streaming.runner")
    recs = [{"after": {"p_brand": "Brand#1", "p_name": f"t{i}"}, "op": "c" if i % 2 else "d",
             "before": {"p_brand": "Brand#1", "p_name": f"t{i}"}} for i in range(10)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(r) for r in recs) + "\n")
    (tmp_path / "job.yaml").write_text(JOB)
    spark.sql("CREATE DATABASE IF NOT EXISTS launcher_ns")
    spark.sql("DROP TABLE IF EXISTS spark_catalog.launcher_ns.part_feed")
    code = main(["--job", str(tmp_path / "job.yaml"), "--files", str(tmp_path / "in"),
                 "--table-format", "parquet", "--catalog", "spark_catalog",
                 "--checkpoint-root", str(tmp_path / "cp"), "--available-now"])
    assert code == 0
    deadline = time.time() + 10       # progress events arrive asynchronously
    while "10 rows" not in caplog.text and time.time() < deadline:
        time.sleep(0.2)
    assert "10 rows" in caplog.text
    rows = spark.table("spark_catalog.launcher_ns.part_feed").collect()
    assert sorted(r.p_name for r in rows) == ["t1", "t3", "t5", "t7", "t9"]
    assert {r.op for r in rows} == {"c"}


def test_main_reports_failure(tmp_path):
    (tmp_path / "job.yaml").write_text("kafka:\n  data_format: avro\n")
    assert main(["--job", str(tmp_path / "job.yaml")]) == 1


def test_properties_win_over_environment(tmp_path, monkeypatch):
    monkeypatch.setenv("BROKERS", "from-env:9092")
    (tmp_path / "job.yaml").write_text(JOB)
    (tmp_path / "common.yaml").write_text(COMMON)
    (tmp_path / "app.properties").write_text("# comment\nBROKERS=from-props:9092\nEMPTY=\n")
    args = parser().parse_args(["--job", str(tmp_path / "job.yaml"), "--common", str(tmp_path / "common.yaml"),
                                "--properties", str(tmp_path / "app.properties")])
    assert build_spec(args).source.bootstrap_servers == "from-props:9092"
