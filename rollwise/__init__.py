"""Rolling customer features on Spark: one wide row per customer account for an anchor date."""

from rollwise.params import Params, Period

__all__ = ["Params", "Period"]
