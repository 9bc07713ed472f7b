"""Column expressions shared by the operators, mappings and jobs."""
