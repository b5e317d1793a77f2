"""Readers for landed page bodies."""
