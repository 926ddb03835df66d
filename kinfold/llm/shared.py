"""The folder that the driver and all executors share, and tables in it."""

from __future__ import annotations

from kinfold.operators.components import clean, discard, release, remove, saved, shared_dir

__all__ = ["clean", "discard", "release", "remove", "saved", "shared_dir"]
