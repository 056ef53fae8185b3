"""Columns, types and readers/writers of the sale-line data."""
