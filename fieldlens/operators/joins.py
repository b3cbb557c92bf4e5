"""Literal mappings.  All other joins are left to Catalyst and AQE, which
broadcast a side only when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_by_mapping(c: Column, mapping: dict) -> Column:
    """Look a value up in a fixed mapping (no join needed); unmapped -> null."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return m[c]
