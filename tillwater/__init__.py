"""Tillwater: shop analytics as plain DataFrame transformations.

Page logs and database changes come in, cleaned facts, wide tables, windowed
statistics and dashboard answers come out. Every transformation takes and
returns DataFrames; most run unchanged on batch and streaming input.
"""

from tillwater.session import build_session, scratch_dir, staged, tune

__all__ = ["build_session", "scratch_dir", "staged", "tune"]
