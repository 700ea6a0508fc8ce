"""roadrisk: incident-risk analytics expressed as Spark DataFrame plans.

Layout
------
sources/    readers and writers (adapter tables, feature JSON, grid, stages, CSV, model files)
functions/  column-level rules (calendar, cleaning, hour blocks, severity, scaling)
operators/  relational operators (filters, joins, aggregates, windows, integrity, k-prototypes)
plans/      composite jobs (feature table, prediction, motorcycle crosstabs, loads)
streaming/  the monthly append as a Structured Streaming ``foreachBatch`` body
"""

from roadrisk.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
