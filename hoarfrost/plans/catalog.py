"""All registered queries, collected by importing the modules that declare them."""

from hoarfrost.plans import (  # noqa: F401
    queries_generate,
    queries_loads,
    queries_quality,
    queries_relational,
    queries_reports,
)
from hoarfrost.plans.registry import ORACLES, QUERIES  # noqa: F401
