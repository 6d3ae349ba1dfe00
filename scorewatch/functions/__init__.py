"""Column helpers (pure ``Column -> Column`` built-ins, no Python UDFs)."""
