"""Every registered query; importing this module fills the registry."""

from rowwarden.plans import (  # noqa: F401
    anomalies, classify, hashes, keyed_tables, measures, parsing, reconciliation, routes, rulesets,
)
from rowwarden.plans.registry import ORACLES, QUERIES  # noqa: F401

FLAGSHIP = "advanced_quality_flow"
