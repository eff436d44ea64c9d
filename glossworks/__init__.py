"""Spark jobs for the table work behind sign-language data sets."""
