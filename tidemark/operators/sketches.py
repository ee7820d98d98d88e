"""Mergeable sketches: approximate distinct counts and quantiles that add up.

A batch is reduced to one small binary per group and column: an HLL sketch of distinct
values, a KLL sketch of quantiles.  Sketches of batches, hours or tables are merged
later without the rows, in any order and grouping, and the merged sketch is what one
sketch of all the rows would be (within the same error).  All native aggregates,
combined before the shuffle.

Errors: HLL with ``lg_k`` has a relative standard error of 1.04 / sqrt(2 ** lg_k), used
here as three of them; KLL with ``k`` has a normalised rank error of about
2.296 / k ** 0.9021 (99 % confidence).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FractionalType, IntegralType

LG_K = 12
KLL_K = 200
DISTINCT, QUANTILES = "_distinct", "_quantiles"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def hll_error(lg_k: int = LG_K) -> float:
    """Relative error that an estimate keeps within in all but about 0.3 % of cases."""
    return 3 * 1.04 / math.sqrt(2 ** lg_k)


def kll_error(k: int = KLL_K) -> float:
    """Rank error, as a share of the rows."""
    return 2.296 / k ** 0.9021


def sketch(df: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = (), *,
           lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """One row per group: ``rows``, ``<column>_distinct`` and ``<column>_quantiles``.
    Nulls are in no sketch."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in distinct:
        whole = df.schema[c].dataType
        value = _col(c) if isinstance(whole, IntegralType) else _col(c).cast("string")
        aggs.append(F.hll_sketch_agg(value.cast("bigint") if isinstance(whole, IntegralType) else value,
                                     F.lit(lg_k)).alias(c + DISTINCT))
    for c in quantiles:
        if not isinstance(df.schema[c].dataType, (FractionalType, IntegralType)):
            raise ValueError(f"quantiles need numbers: {c} is {df.schema[c].dataType.simpleString()}")
        aggs.append(F.kll_sketch_agg_double(_col(c).cast("double"), F.lit(k)).alias(c + QUANTILES))
    return df.groupBy(*[_col(x) for x in keys]).agg(*aggs)


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of each group (of fewer or the same keys) as one."""
    aggs = [F.sum("rows").alias("rows")]
    for c in sketches.columns:
        if c.endswith(DISTINCT):
            aggs.append(F.hll_union_agg(_col(c), F.lit(True)).alias(c))
        elif c.endswith(QUANTILES):
            aggs.append(F.kll_merge_agg_double(_col(c)).alias(c))
    return sketches.groupBy(*[_col(x) for x in keys]).agg(*aggs)


def estimates(sketches: DataFrame, ranks: Mapping[str, float] | None = None) -> DataFrame:
    """Each sketch as numbers: ``<column>_distinct`` a count, and for every name and rank
    ``<column>_<name>`` a quantile (by default the median)."""
    out = []
    for c in sketches.columns:
        if c.endswith(DISTINCT):
            out.append(F.hll_sketch_estimate(_col(c)).alias(c))
        elif c.endswith(QUANTILES):
            base = c.removesuffix(QUANTILES)
            # a sketch of no values has no quantiles
            out += [F.when(F.kll_sketch_get_n_double(_col(c)) > 0, F.kll_sketch_get_quantile_double(_col(c), F.lit(float(r))))
                    .alias(f"{base}_{n}") for n, r in (ranks or {"median": 0.5}).items()]
        else:
            out.append(_col(c))
    return sketches.select(*out)
