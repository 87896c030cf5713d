"""The six input tables derived from the driver's test tables, in Spark and in DuckDB SQL."""
