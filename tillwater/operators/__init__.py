"""Transformations of the cleaning, joining and statistics layers."""
