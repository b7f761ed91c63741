"""Functions: Column to Column."""
