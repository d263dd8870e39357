"""Models: dimensions, fact, KPIs, quality checks, dashboard, warehouse."""
