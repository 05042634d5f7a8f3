"""All registered queries of the factor engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.plans.queries import expression_query, factor_batches
from weftline.plans.panel_queries import ORACLE as PANEL_ORACLE
from weftline.plans.panel_queries import QUERIES as PANEL_QUERIES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(PANEL_QUERIES)
ORACLE: dict[str, str] = dict(PANEL_ORACLE)
for _name, _outputs in factor_batches().items():
    QUERIES[_name], ORACLE[_name] = expression_query(_outputs)
