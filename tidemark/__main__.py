"""Run a job from its files: ``python -m tidemark --job job.yaml [--common common.yaml]``.

Meant for ``spark-submit`` (or any launcher that provides the cluster
configuration): the session is taken with ``getOrCreate``.  ``${VAR}`` and
``${VAR:-default}`` in the files are filled before they are read, from a
``key=value`` properties file (``--properties``; it wins) and the
environment; values are never printed.  ``--files PATH`` reads change records
from JSON text files instead of Kafka (replays, tests); ``--available-now``
processes what is there and stops.  A failure ends the process with status 1.
"""

from __future__ import annotations

import argparse
import logging
import os
import re
import sys
from collections.abc import Mapping

_VAR = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


def expand(text: str, env: Mapping[str, str] | None = None) -> str:
    """Fill the placeholders; one without a default must have a value."""
    env = os.environ if env is None else env
    missing = sorted({m[1] for m in _VAR.finditer(text) if m[2] is None and m[1] not in env})
    if missing:
        raise ValueError(f"no value for {', '.join(missing)}: set it in the properties file or the environment")
    return _VAR.sub(lambda m: env.get(m[1], m[2]), text)


def read_properties(path: str | None) -> dict[str, str]:
    """``key=value`` lines; blank lines, ``#`` comments and empty values are skipped."""
    props: dict[str, str] = {}
    if not path:
        return props
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if not line or line.startswith("#") or "=" not in line:
                continue
            key, value = (part.strip() for part in line.split("=", 1))
            if key and value:
                props[key] = value
    return props


def build_spec(args: argparse.Namespace):
    from tidemark.job_config import load_job_yaml

    env = {**os.environ, **read_properties(args.properties)}
    with open(args.job) as fh:
        job_text = expand(fh.read(), env)
    common_text = None
    if args.common:
        with open(args.common) as fh:
            common_text = expand(fh.read(), env)
    spec = load_job_yaml(job_text, common_text, table_format=args.table_format,
                         checkpoint_root=args.checkpoint_root)
    if args.files:
        spec.source.kind = "files"
        spec.source.path = args.files
        spec.source.max_files_per_trigger = args.max_files_per_trigger
    if args.catalog:
        spec.catalog = args.catalog
    return spec


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tidemark", description=__doc__.splitlines()[0])
    p.add_argument("--job", required=True, help="job file (job / spark / kafka / output)")
    p.add_argument("--common", help="common file (kafka connection, table properties)")
    p.add_argument("--properties", help="key=value file filling ${VAR} placeholders (wins over the environment)")
    p.add_argument("--table-format", default="iceberg", help="format of the target table")
    p.add_argument("--catalog", help="catalog of one- and two-part table names")
    p.add_argument("--checkpoint-root", help="root of the job's checkpoints (default: spark.checkpoint.dir)")
    p.add_argument("--files", help="read change records from JSON text files under this path")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    from pyspark.sql import SparkSession

    from tidemark.streaming.runner import ProgressLog, run_job

    try:
        spec = build_spec(args)
        spark = SparkSession.builder.appName(f"streaming-{spec.name}").getOrCreate()
        run_job(spark, spec, available_now=args.available_now, progress=ProgressLog(keep=1))
    except Exception:
        logging.getLogger("tidemark").exception("job failed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
