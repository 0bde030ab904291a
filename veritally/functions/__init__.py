"""Column expressions; every one is built in and runs inside code generation."""
