"""Column expressions. Every function here maps columns to a column and stays inside code generation."""
