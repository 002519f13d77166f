"""All registered queries: importing the query modules fills the registry."""

from mailtally.plans import (  # noqa: F401
    flagship,
    queries_extract,
    queries_landing,
    queries_messages,
    queries_recon,
    queries_sinks,
    queries_tables,
)
from mailtally.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
