"""Imports every query module, which fills the registry."""

from metaferry.snapshots import asset_queries, config_queries, document_queries, policy_queries  # noqa: F401
from metaferry.snapshots.registry import ORACLES, QUERIES  # noqa: F401
