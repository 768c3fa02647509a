"""Shapes of deskewed scans. The resampling is in chunks.py, what fills the overhang in volumes.py."""

from __future__ import annotations

import math


def deskewed_shape(shape: tuple[int, int, int], angle: float, ratio: float, keep_overhang: bool) -> tuple[int, int, int]:
    """The full output shape (before averaging) of a light-sheet scan: raw (z, y, x) becomes (y, x, along the scan)."""
    nz, ny, nx = shape
    shear = ny * math.cos(math.radians(angle))
    length = math.ceil(nz / ratio + shear) if keep_overhang else math.ceil(nz / ratio - shear)
    if length <= 0:
        raise ValueError("the volume has fewer planes than the tilt needs without the overhang")
    return ny, nx, length
