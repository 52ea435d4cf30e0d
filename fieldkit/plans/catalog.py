"""All registered queries by name."""

from __future__ import annotations

from fieldkit.plans.cluster_queries import QUERIES as CLUSTERS
from fieldkit.plans.signal_queries import QUERIES as SIGNALS
from fieldkit.plans.site_queries import QUERIES as SITES
from fieldkit.plans.stand_ins import Query
from fieldkit.plans.table_queries import QUERIES as TABLES

CATALOG: dict[str, Query] = {**SIGNALS, **SITES, **CLUSTERS, **TABLES}
