"""Every query for the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from gristmill.plans import dataset_queries, detection_queries, event_queries, text_queries, warehouse_queries

_PARTS = (text_queries, event_queries, dataset_queries, detection_queries, warehouse_queries)
QUERIES: dict = {k: v for part in _PARTS for k, v in part.Q.items()}
ORACLES: dict[str, str] = {k: v for part in _PARTS for k, v in part.O.items()}
