"""Column expressions: pure functions from columns to columns, no Python UDFs."""
