"""Flattening, querying and checking of wide-map fact tables, as Spark DataFrame jobs."""
