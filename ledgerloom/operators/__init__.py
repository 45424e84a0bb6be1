"""Reusable `DataFrame -> DataFrame` operators."""
