"""Column expressions (all built-in, JVM-side; no UDFs)."""

from upswing.functions.columns import (
    first_token,
    first_usable_title,
    hour_bucket,
    surge_z,
    suppress_low,
)

__all__ = ["first_token", "first_usable_title", "hour_bucket", "surge_z", "suppress_low"]
