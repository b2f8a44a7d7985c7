"""All registered queries; importing a query module registers its entries."""

from tallyfold.plans import (  # noqa: F401
    queries_forecast,
    queries_models,
    queries_monitor,
    queries_profiles,
    queries_tables,
)
from tallyfold.plans.registry import CHECKS, QUERIES  # noqa: F401
