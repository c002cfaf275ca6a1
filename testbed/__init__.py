"""Inputs, queries and expected-result SQL for the driver tables; not part of the library."""
