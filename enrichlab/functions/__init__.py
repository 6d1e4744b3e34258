"""Column -> Column functions (scalars, null rules, buckets, time helpers)."""

from enrichlab.functions.scalars import *  # noqa: F401,F403
