"""Imports every query module, so that the registry is complete."""

from schemaward.workload import q_ddl, q_matching, q_pages, q_resolver, q_sources, q_text, q_titles  # noqa: F401
from schemaward.workload.registry import ORACLES, QUERIES  # noqa: F401
