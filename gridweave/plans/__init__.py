"""Registered queries: grids and points, routes and catalogues, files."""

from gridweave.plans import grids, ingest, sites
from gridweave.plans.relations import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "grids", "ingest", "sites"]
