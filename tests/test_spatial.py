"""Hilbert keys against a walk of one bit a step, and cells of the hexagonal grid."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamark.functions import hexagons, spatial


def walked(latitude, longitude):
    if latitude is None or longitude is None or abs(latitude) > 90 or abs(longitude) > 180:
        return None
    cells = 1 << spatial.BITS
    x, y, place = min(int((longitude + 180) / 360 * cells), cells - 1), min(int((latitude + 90) / 180 * cells), cells - 1), 0
    for k in reversed(range(spatial.BITS)):
        low = (1 << k) - 1
        rx, ry = x >> k & 1, y >> k & 1
        place, x, y = 4 * place + (3 * rx ^ ry), x & low, y & low
        if not ry:
            x, y = (low - y, low - x) if rx else (y, x)
    return place


def test_hilbert(spark):
    draw = random.Random(1)
    some = [(a, o) for a in (-90.0, 0.0, 90.0) for o in (-180.0, 0.0, 180.0)]
    some += [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(300)]
    some += [(None, 1.0), (1.0, None), (90.5, 1.0), (1.0, -180.5)]
    rows = spark.createDataFrame(some, "a double, o double").select("a", "o", spatial.hilbert(F.col("a"), F.col("o")).alias("h")).collect()
    assert len(rows) == len(some)
    assert all(r["h"] == walked(r["a"], r["o"]) for r in rows)


#: Published cells: San Francisco, its bay, the Statue of Liberty, and where the meridian meets the equator.
CELLS = [(37.7752702151959, -122.418307270836, 9, "8928308280fffff"), (37.3615593, -122.0553238, 5, "85283473fffffff"), (37.3615593, -122.0553238, 7, "87283472bffffff"), (40.689167, -74.044444, 10, "8a2a1072b59ffff"), (0.0, 0.0, 5, "85754e67fffffff"), (0.0, 0.0, 0, "8075fffffffffff")]


def test_published_cells():
    for latitude, longitude, resolution, text in CELLS:
        assert f"{hexagons.cells(np.array([latitude]), np.array([longitude]), resolution)[0]:x}" == text


def test_base_cells_follow_from_the_faces():
    where, own, pentagon = hexagons.base_cells()
    assert len(where) == 122 and np.flatnonzero(pentagon).tolist() == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
    assert hexagons.reached()[0, 2, 1, 0].tolist()[:2] == [15, 1] and hexagons.reached()[5, 0, 0, 2].tolist()[:2] == [49, 3]


@pytest.mark.parametrize("resolution", [0, 1, 2, 3])
def test_every_cell_is_found_and_lies_in_one_place(resolution):
    """Points all over the sphere meet exactly the grid's cells, and those of a cell lie around one centre, at faces' edges and pentagons too."""
    rng = np.random.default_rng(resolution)
    v = rng.normal(size=(2_000_000 if resolution == 3 else 1_000_000, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    found = hexagons.cells(np.degrees(np.arcsin(v[:, 2])), np.degrees(np.arctan2(v[:, 1], v[:, 0])), resolution)
    kinds, own = np.unique(found, return_inverse=True)
    assert len(kinds) == 2 + 120 * 7**resolution
    middle = np.zeros((len(kinds), 3))
    np.add.at(middle, own, v)
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    away = np.arccos(np.clip((v * middle[own]).sum(axis=1), -1, 1))
    assert np.degrees(away.max()) < 16 / 7 ** (resolution / 2)


def test_digits_of_a_finer_cell_begin_with_its_parents():
    rng = np.random.default_rng(8)
    latitude, longitude = rng.uniform(-89, 89, 20_000), rng.uniform(-180, 180, 20_000)
    fine, coarse = (hexagons.cells(latitude, longitude, r) for r in (10, 9))
    same = (fine >> 18 & 0x7FFFFFF) == (coarse >> 18 & 0x7FFFFFF)
    assert same.mean() > 0.8 and ((fine >> 52 & 15) == 10).all()


def test_cells_of_columns(spark):
    rows = [(1, 40.689167, -74.044444), (2, None, 1.0), (3, 91.0, 0.0), (4, float("nan"), 0.0), (5, 90.0, 180.0)]
    got = {r.id: r.cell for r in spark.createDataFrame(rows, "id int, a double, b double").select("id", hexagons.h3(F.col("a"), F.col("b")).alias("cell")).collect()}
    assert f"{got[1]:x}" == "8a2a1072b59ffff" and got[2] is got[3] is got[4] is None and got[5] > 0
