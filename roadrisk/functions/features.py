"""Feature-level column rules: hour block (F9), severity index (F10), priority label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadrisk.schemas import HOUR_BLOCKS, PRIORITY_MAP


def hour_block(hour: Column) -> Column:
    """hour 0..23 -> time block name; anything else -> null."""
    names = F.array(*[F.lit(HOUR_BLOCKS[h]) for h in range(24)])
    return F.when(hour.between(0, 23), F.try_element_at(names, hour.cast("int") + 1))


def severity_index(killed_vulnerable: Column, injured_vulnerable: Column) -> Column:
    """0 = no vulnerable victim, 1 = vulnerable injured only, 2 = any vulnerable killed
    (or any other combination)."""
    mv, hv = killed_vulnerable, injured_vulnerable
    return (F.when((mv == 0) & (hv == 0), F.lit(0))
            .when((hv > 0) & (mv == 0), F.lit(1))
            .otherwise(F.lit(2)))


def label_to_priority(label: Column, mapping: dict | None = None) -> Column:
    """cluster label -> priority text through a literal map (no UDF)."""
    mapping = PRIORITY_MAP if mapping is None else mapping
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, label)
