"""The table-by-day work plan, and the sync run that carries it out."""
