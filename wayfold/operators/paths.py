"""Paths on the sphere, in arrays: simplification within a tolerance in metres."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Mean radius of the earth.
METRES = 6_371_008.8


def _on_sphere(points: np.ndarray) -> np.ndarray:
    """Unit vectors of points of longitude and latitude in degrees."""
    lon, lat = np.radians(points[:, 0]), np.radians(points[:, 1])
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Metres between unit vectors; by the chord, which is exact for near ones too."""
    return 2 * METRES * np.arcsin(np.clip(np.linalg.norm(p - q, axis=-1) / 2, 0, 1))


def metres_from(p: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Metres from unit vectors ``p`` to the shorter great-circle stretch from a to z."""
    ends = np.minimum(_apart(p, a), _apart(p, z))
    pole = np.cross(a, z)
    size = np.linalg.norm(pole)
    if size < 1e-15:  # the ends are one point
        return ends
    pole = pole / size
    beside = (np.cross(a, p) @ pole >= 0) & (np.cross(p, z) @ pole >= 0)
    return np.where(beside, np.minimum(METRES * np.abs(np.arcsin(np.clip(p @ pole, -1, 1))), ends), ends)


def simplified(points: np.ndarray, metres: float) -> np.ndarray:
    """Which points of a path stay, in order: both ends, and between two that stay the
    one farthest off their stretch, as long as it is more than ``metres`` off. A closed
    ring keeps its point farthest from its start, so that it doesn't collapse into it."""
    if len(points) < 3:
        return np.arange(len(points))
    at = _on_sphere(points)
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, z = todo.pop()
        if z - a < 2:
            continue
        off = metres_from(at[a + 1 : z], at[a], at[z])
        k = int(off.argmax())
        if off[k] > metres or a == 0 and z == len(points) - 1 and (points[0] == points[-1]).all():
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, z)]
    return np.flatnonzero(keep)


def simplify(rows: DataFrame, column: str, metres: float, kind: str, into: str) -> DataFrame:
    """``rows`` with their paths (lists of longitude and latitude) as simplified GeoJSON in
    ``into`` and the number of points left in ``points``; ``kind`` is LineString, or
    Polygon for closed rings. A null or empty path has null and no points."""
    others = [c for c in rows.columns if c != column]

    def shape(path: pa.Scalar) -> tuple[str | None, int]:
        if not path.is_valid or not len(path.values):
            return None, 0
        points = path.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
        kept = points[simplified(points, metres)].tolist()
        return json.dumps({"type": kind, "coordinates": [kept] if kind == "Polygon" else kept}), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shape(p) for p in batch.column(len(others))]
            arrays = [pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *arrays], [*others, into, "points"])

    own = rows.select(*others, column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != column)
    return own.mapInArrow(run, f"{schema}, `{into}` string, points int")
