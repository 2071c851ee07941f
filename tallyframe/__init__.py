"""Table and event jobs written as plain PySpark ``DataFrame -> DataFrame`` functions."""
