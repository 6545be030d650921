"""dimweave: data-modelling operators (cumulative snapshots, type-2 history,
graph tables, fact tables, date-list bits, metric arrays, table layout,
row-level change, stage-audit-publish) as PySpark DataFrame jobs."""
