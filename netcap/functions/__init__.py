"""Column expressions (built-in Spark functions only, codegen friendly)."""

from netcap.functions.columns import (
    age_seconds, as_timestamp_ntz, component_amount, composite_key, epoch_millis,
    freshness_status, is_fresh, money, sector_for_rule,
)

__all__ = [
    "age_seconds", "as_timestamp_ntz", "component_amount", "composite_key", "epoch_millis",
    "freshness_status", "is_fresh", "money", "sector_for_rule",
]
