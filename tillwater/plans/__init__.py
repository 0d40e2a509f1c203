"""Whole plans: the layers of the shop warehouse, and the registered queries."""
