"""Column expressions: pure ``Column -> Column`` helpers, no UDFs."""
