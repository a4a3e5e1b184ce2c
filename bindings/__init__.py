"""Operators bound to the test tables, with the SQL that checks each of them."""
