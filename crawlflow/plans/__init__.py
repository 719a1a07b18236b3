"""Declarative jobs over the operators."""
