"""The registered queries: each operator over the given tables, with SQL to check it against."""
