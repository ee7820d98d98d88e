"""SQL functions a job's per-batch SQL may call.

They are SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``), which
the analyzer inlines into the plan: no Python worker is involved.  They must be
created before a stream starts so that the micro-batch sessions see them.

``transform_phone_number(p)``: keep the digits of ``p``; when they start with
``00<cc>`` or ``<cc>`` and at least nine digits follow, that prefix becomes a
single ``0`` (national form); no digits at all gives null.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Name of the phone function in job SQL.
PHONE_FUNCTION = "transform_phone_number"
DEFAULT_COUNTRY_CODE = "84"

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def phone_function_sql(country_code: str | None = None, name: str = PHONE_FUNCTION) -> str:
    cc = DEFAULT_COUNTRY_CODE if country_code is None else str(country_code)
    if not cc.isdigit():
        raise ValueError(f"country code must be digits: {cc!r}")
    if not _NAME.match(name):
        raise ValueError(f"bad function name: {name!r}")
    digits = "regexp_replace(p, '[^0-9]', '')"
    return (
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(p STRING) RETURNS STRING RETURN "
        f"CASE WHEN {digits} = '' THEN NULL "
        f"WHEN {digits} RLIKE '^00{cc}[0-9]{{9,}}$' THEN concat('0', substr({digits}, {len(cc) + 3})) "
        f"WHEN {digits} RLIKE '^{cc}[0-9]{{9,}}$' THEN concat('0', substr({digits}, {len(cc) + 1})) "
        f"ELSE {digits} END"
    )


def register_functions(spark: SparkSession, functions: Mapping[str, str] | None = None,
                       phone_country_code: str | None = None) -> list[str]:
    """Create the phone function plus the job's own ``{name: signature-and-body}``
    functions, e.g. ``{"net": "(p DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN p * (1 - d)"}``."""
    spark.sql(phone_function_sql(phone_country_code))
    created = [PHONE_FUNCTION]
    for name, body in (functions or {}).items():
        if not _NAME.match(name):
            raise ValueError(f"bad function name: {name!r}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        created.append(name)
    return created
