"""Checks on the driver's test tables: stand-in inputs, the registered queries, their SQL twins."""
