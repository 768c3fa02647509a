"""Affine matrices as nested lists, on (z, y, x, 1): builders, composition and conversion. Matrices are settings, so they live on the driver."""

from __future__ import annotations

import math

import numpy as np

Matrix = list[list[float]]


def identity() -> Matrix:
    return np.eye(4).tolist()


def translation(z: float, y: float, x: float) -> Matrix:
    m = np.eye(4)
    m[:3, 3] = z, y, x
    return m.tolist()


def rescale_about(factor: float, start_yx: tuple[int, int], end_yx: tuple[int, int]) -> Matrix:
    """Scale y and x so that the centre of the start shape lands on that of the end shape."""
    m = np.eye(4)
    for axis, (a, b) in enumerate(zip(start_yx, end_yx, strict=True), 1):
        m[axis, axis], m[axis, 3] = factor, b / 2 - factor * a / 2
    return m.tolist()


def rotation_about(degrees: float, start_yx: tuple[int, int], end_yx: tuple[int, int]) -> Matrix:
    """Turn in the plane about the centres."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    m, (ay, ax), (by, bx) = np.eye(4), start_yx, end_yx
    m[1:3, 1:3] = [[c, -s], [s, c]]
    m[1:3, 3] = np.array([by, bx]) / 2 - m[1:3, 1:3] @ (np.array([ay, ax]) / 2)
    return m.tolist()


def mirror_x(width: float) -> Matrix:
    m = np.eye(4)
    m[2, 2], m[2, 3] = -1, width
    return m.tolist()


def approximate(moving: tuple[int, int, int], fixed: tuple[int, int, int], moving_voxel: tuple[float, float, float], fixed_voxel: tuple[float, float, float], quarter_turns: int = -1, mirror: bool = False) -> Matrix:
    """The matrix from fixed to moving voxels of volumes of these shapes (z, y, x) and voxel sizes before anything is estimated: the moving one mirrored along x if asked for, turned by quarters in the plane about the centres, and scaled about the fixed one's
    centre by the voxels' ratios (that of x for y, too)."""
    depth, wide = moving_voxel[0] / fixed_voxel[0], moving_voxel[2] / fixed_voxel[2]
    scale = np.array(rescale_about(wide, fixed[1:], fixed[1:]))
    scale[0, 0] = depth
    flip = mirror_x(moving[2]) if mirror else identity()
    return invert(compose(scale.tolist(), rotation_about(90.0 * quarter_turns, moving[1:], fixed[1:]), flip))


def stabilised_shape(first: Matrix, shape: tuple[int, int, int], tolerance: float = 10.0) -> tuple[int, int, int]:
    """The output shape of a series that begins with this matrix: with y and x changed where it turns the plane by 90 degrees, give or take the tolerance. Scaling doesn't count."""
    u, _, vt = np.linalg.svd(np.array(first)[:3, :3])
    r = u @ vt
    turn = math.degrees(math.atan2(r[2, 1], r[2, 2]))
    z, y, x = shape
    return (z, x, y) if abs(turn - 90) <= tolerance + 90e-5 else (z, y, x)


def compose(*matrices: Matrix) -> Matrix:
    """The first matrix applied last."""
    out = np.eye(4)
    for m in matrices:
        out = out @ np.array(m)
    return out.tolist()


def invert(m: Matrix) -> Matrix:
    return np.linalg.inv(np.array(m)).tolist()


def apply(m: Matrix, point: tuple[float, float, float]) -> tuple[float, ...]:
    return tuple((np.array(m) @ [*point, 1])[:3].tolist())


def voxel_size(m: Matrix, scale: tuple[float, float, float]) -> tuple[float, ...]:
    """The voxel size after resampling by a matrix: its rows' lengths times the scale."""
    return tuple((np.linalg.norm(np.array(m)[:3, :3], axis=1) * scale).tolist())


def from_center(linear: list[list[float]], shift: tuple[float, float, float], center: tuple[float, float, float]) -> Matrix:
    """The matrix of a linear map about a centre, followed by a shift."""
    a, m = np.array(linear), np.eye(4)
    m[:3, :3], m[:3, 3] = a, np.array(shift) + (np.eye(3) - a) @ np.array(center)
    return m.tolist()


def with_crop(initial: Matrix, optimised: Matrix, offset: tuple[float, float, float]) -> Matrix:
    """The whole transform when the optimised one was found inside a crop at the offset."""
    t = translation(*offset)
    return compose(initial, t, optimised, invert(t))
