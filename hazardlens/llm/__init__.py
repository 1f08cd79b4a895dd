"""Training-data operators: filters, near-duplicates, search, mixing, packing.

Nothing else in the library imports this subpackage. ``registry`` holds the
queries ``opN_<name>`` and the DuckDB SQL of those that SQL can express.
"""
