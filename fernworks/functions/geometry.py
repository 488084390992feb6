"""Line simplification of polygons in GeoJSON: points that stay within a tolerance of the chord are left out."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Segments whose crossings with all others are looked for at once.
BLOCK = 512


def _away(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of points from the segment between a and b."""
    dx, dy = b - a
    px, py = (points - a).T
    size = dx * dx + dy * dy
    from_a = px * px + py * py
    if size == 0:
        return from_a
    along = px * dx + py * dy
    cross = px * dy - py * dx
    qx, qy = (points - b).T
    return np.where(along <= 0, from_a, np.where(along >= size, qx * qx + qy * qy, cross * cross / size))


def kept_points(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points of a line stay (booleans): its ends, and from each stretch the farthest from its chord if that is
    farther than the tolerance (the first of equal ones), which parts the stretch in two."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        away = _away(points[i + 1 : j], points[i], points[j])
        k = int(away.argmax())
        if away[k] > tolerance * tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return keep


def simple_ring(points: np.ndarray, tolerance: float) -> np.ndarray:
    """A closed ring with fewer points; closed too, and of four points at least (as the ring had)."""
    keep = kept_points(points, tolerance)
    while keep.sum() < min(4, len(points)):  # the farthest from what is there
        at = np.flatnonzero(keep)
        away = np.concatenate([np.append(0.0, _away(points[i + 1 : j], points[i], points[j])) for i, j in zip(at, at[1:], strict=False)] + [np.zeros(1)])
        away[keep] = -1
        keep[int(away.argmax())] = True
    return points[keep]


def crosses(rings: list[np.ndarray]) -> bool:
    """Whether two segments of the rings cross, or lie on each other in part; neighbours meet at their common point only."""
    a = np.concatenate([r[:-1] for r in rings])
    b = np.concatenate([r[1:] for r in rings])
    ring = np.repeat(range(len(rings)), [len(r) - 1 for r in rings])
    place = np.concatenate([np.arange(len(r) - 1) for r in rings])
    size = np.array([len(r) - 1 for r in rings])[ring]
    side = lambda p, q, r: np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))
    within = lambda p, q, r: (np.minimum(p, q) <= r).all(-1) & (r <= np.maximum(p, q)).all(-1)
    for k in range(0, len(a), BLOCK):
        p, q = a[k : k + BLOCK, None], b[k : k + BLOCK, None]
        s1, s2, s3, s4 = side(p, q, a[None]), side(p, q, b[None]), side(a[None], b[None], p), side(a[None], b[None], q)
        meet = (s1 * s2 < 0) & (s3 * s4 < 0)
        meet |= (s1 == 0) & within(p, q, a[None]) | (s2 == 0) & within(p, q, b[None]) | (s3 == 0) & within(a[None], b[None], p) | (s4 == 0) & within(a[None], b[None], q)
        same = ring[k : k + BLOCK, None] == ring[None]
        step = (place[None] - place[k : k + BLOCK, None]) % size[None]
        meet &= ~(same & ((step <= 1) | (step == size[None] - 1)))
        if meet.any():
            return True
    return False


def simple_polygon(rings: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """The rings of a polygon with fewer points; where they would cross, with half the tolerance, and so on."""
    if tolerance <= 0 or crosses(rings):  # what is no valid polygon stays as it is
        return rings
    for k in range(20):
        out = [simple_ring(r, tolerance / 2**k) if len(r) > 4 else r for r in rings]
        if not crosses(out):
            return out
    return rings


def _simplified(kind: str | None, coordinates: str | None, tolerance: float) -> str | None:
    if coordinates is None or kind not in ("Polygon", "MultiPolygon"):
        return coordinates
    polygons = json.loads(coordinates)
    out = []
    for rings in [polygons] if kind == "Polygon" else polygons:
        arrays = [np.array([p[:2] for p in r], float) for r in rings]
        out.append([r.tolist() for r in simple_polygon(arrays, tolerance)] if arrays and all(len(r) >= 4 for r in arrays) else rings)
    return json.dumps(out[0] if kind == "Polygon" else out, separators=(",", ":"))


def simplify(kind: Column, coordinates: Column, tolerance: float) -> Column:
    """The coordinates (GeoJSON text) of polygons and multipolygons with fewer points; others, and null, as they are.

    No point that is left out was farther from its chord than the tolerance. Rings stay closed and have four points at
    least; where the rings of a polygon would cross, they are simplified by half the tolerance, and so on. Tolerance 0
    (or less) changes nothing. Heights are left out where a ring is simplified.
    """

    @F.pandas_udf("string")
    def run(kinds: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([_simplified(k, t, tolerance) for k, t in zip(kinds, texts, strict=True)], dtype=object)

    return run(kind, coordinates)
