"""Registered queries on the provided tables, with the SQL each is checked against."""
