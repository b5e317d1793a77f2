"""Typed column builders shared by the operators."""
