"""Stable record ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from srcsieve.constants import DOC_ID_PREFIX


def doc_id(*parts: Column | str, prefix: str = DOC_ID_PREFIX) -> Column:
    """``prefix-<sha256>`` over the parts, so a rerun gives the same id."""
    columns = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit(f"{prefix}-"), F.sha2(F.concat_ws("\n", *columns), 256))
