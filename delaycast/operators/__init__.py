"""DataFrame operators: enrichment joins, distincts, outliers, order statistics, metrics."""
