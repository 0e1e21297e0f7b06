"""Query operators: retail, data quality, catalog, ERA screening, statistics, reports."""
