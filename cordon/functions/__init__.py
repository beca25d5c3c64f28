"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from cordon.functions.sample import hash_fraction_threshold, hash_sample, in_hash_sample
from cordon.functions.stats import guarded_corr, ols_fit
from cordon.functions.time import (
    day_name,
    in_period,
    seconds_between,
    shift_years,
    speed_mph,
    ts_lit,
)
from cordon.functions.zones import entering, inside, not_in_zone, touching, in_zone

__all__ = [
    "hash_fraction_threshold", "hash_sample", "in_hash_sample",
    "guarded_corr", "ols_fit",
    "day_name", "in_period", "seconds_between", "shift_years", "speed_mph", "ts_lit",
    "entering", "inside", "not_in_zone", "touching", "in_zone",
]
