"""Column expressions; nothing here needs a session or reads data."""
