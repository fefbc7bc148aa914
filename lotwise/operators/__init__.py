"""DataFrame operators: joins, collapses, dissolve, profiles, summaries."""
