"""DataFrame -> DataFrame operators: quality, projection, scenarios, drivers, dashboard."""
