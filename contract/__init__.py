"""Registered queries on the driver tables, and the SQL they are compared with."""
