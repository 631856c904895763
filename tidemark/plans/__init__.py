"""Warehouse jobs composed of the operators."""
