"""Joins, rollups, reports and page extraction as DataFrame operators."""
