"""Sends this package to the Python workers of a session."""

from __future__ import annotations

from tagmatch.sources.ship import ship

__all__ = ["ship"]
