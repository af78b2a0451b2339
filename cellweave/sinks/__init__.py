"""Sinks: Spark tables, databases over JDBC, and the record of outcomes."""
