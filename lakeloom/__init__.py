"""lakeloom: event data-lake operators and jobs written as plain PySpark."""
