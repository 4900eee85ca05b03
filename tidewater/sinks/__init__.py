"""Sinks: partitioned lake, serving table, dead letters, messages, CSV, DDL."""
