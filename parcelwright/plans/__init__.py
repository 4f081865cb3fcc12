"""Queries over the given tables, a module for each group of operators."""

from parcelwright.plans import counties, matching, profiling, publishing, releases, scalar, scanning, shaping, validating  # noqa: F401
