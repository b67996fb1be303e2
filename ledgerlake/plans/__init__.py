"""Whole jobs: the gated ETL (``etl``) and the registered driver queries
(``catalog``)."""
