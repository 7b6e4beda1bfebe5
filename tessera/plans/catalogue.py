"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from tessera.plans import assignment, barcodes, expression, geometry, kernels, pixels, records, registration, spatial, structures, volumes  # noqa: F401  each registers its queries
from tessera.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
