"""Single operators of the order model, each DataFrame -> DataFrame."""

from . import cleaning, dims, fills, filters, ranking, setops, totals  # noqa: F401
