"""Column expressions. No Python UDF: everything stays inside Catalyst."""
