"""Readers: order files, tables, targets (file or JDBC), and the testbed
adapter over the provided star-schema tables."""
