"""starloom: dimensional warehouses as Spark DataFrame operators.

Every public function takes and returns DataFrames; the caller owns the
session.  See README.md for the map of the package.
"""
