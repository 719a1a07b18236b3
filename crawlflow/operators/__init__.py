"""Operators over message, record and cell DataFrames."""
