"""Field specifications of the bronze tables, grouped by subject."""
