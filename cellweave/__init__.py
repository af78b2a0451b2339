"""Turn messy business tables into clean, typed, audited tables with Spark."""
