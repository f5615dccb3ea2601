"""Readers: landed files, tables, file listings and synthetic rows."""
