"""Composite jobs of the three zones."""

from cityzones.plans.formatters import (  # noqa: F401
    format_incidents, format_income, format_rent, neighborhood_dim,
)
from cityzones.plans.indicators import (  # noqa: F401
    avg_indicators, export_indicators, listing_indicators, population,
)
from cityzones.plans.lookup_builder import build_incident_lookup  # noqa: F401
from cityzones.plans.ml_dataset import ml_dataset  # noqa: F401
