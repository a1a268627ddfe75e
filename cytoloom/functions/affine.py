"""3x3 affine maps held as arrays of nine doubles, row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _m(a: Column, i: int, j: int) -> Column:
    return a[3 * i + j]


def det(a: Column) -> Column:
    return (
        _m(a, 0, 0) * (_m(a, 1, 1) * _m(a, 2, 2) - _m(a, 1, 2) * _m(a, 2, 1))
        - _m(a, 0, 1) * (_m(a, 1, 0) * _m(a, 2, 2) - _m(a, 1, 2) * _m(a, 2, 0))
        + _m(a, 0, 2) * (_m(a, 1, 0) * _m(a, 2, 1) - _m(a, 1, 1) * _m(a, 2, 0))
    )


def inverse(a: Column) -> Column:
    c = lambda i, j, k, n: _m(a, i, j) * _m(a, k, n) - _m(a, i, n) * _m(a, k, j)
    parts = [c(1, 1, 2, 2), -c(0, 1, 2, 2), c(0, 1, 1, 2), -c(1, 0, 2, 2), c(0, 0, 2, 2), -c(0, 0, 1, 2), c(1, 0, 2, 1), -c(0, 0, 2, 1), c(0, 0, 1, 1)]
    return F.array(*[p / det(a) for p in parts])


def um_to_pixel(source: Column, pixel_size: Column) -> Column:
    """From micrometres to image pixels: the inverse of source (image to sensor pixels), with sensor pixels of pixel_size."""
    inv = inverse(source)
    return F.array(*[inv[3 * i + j] / pixel_size if j < 2 else inv[3 * i + j] for i in range(3) for j in range(3)])


def pixel_um(source: Column, pixel_size: Column) -> Column:
    """Size of an image pixel in micrometres."""
    return F.sqrt(F.abs(_m(source, 0, 0) * _m(source, 1, 1) - _m(source, 0, 1) * _m(source, 1, 0))) * pixel_size


def apply_x(m: Column, x: Column, y: Column) -> Column:
    return _m(m, 0, 0) * x + _m(m, 0, 1) * y + _m(m, 0, 2)


def apply_y(m: Column, x: Column, y: Column) -> Column:
    return _m(m, 1, 0) * x + _m(m, 1, 1) * y + _m(m, 1, 2)
