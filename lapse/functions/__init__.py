"""Scalar column functions (F1-F12) and small column helpers."""

from lapse.functions.scalar import *  # noqa: F401,F403
