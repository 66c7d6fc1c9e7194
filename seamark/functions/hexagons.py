"""Cells of the H3 grid: hexagons (and twelve pentagons) that divide the sphere, seven times finer at each resolution.

A point goes to the nearest of the icosahedron's twenty faces and is projected onto its plane, whose hexagons have integer
coordinates along three axes. Of these the parents follow upward, each giving the digit of its child, up to one of 122
base cells. Digits are then turned from the axes of the face on which the point was found to those of the base cell's own
face. Base cells are numbered from north to south. Which of them a face's coordinates reach, and by how many sixths of a
turn its axes lie off those of the cell's own face, follows from where they lie; only the faces' places and the choice of
own faces are given.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the grid: latitude and longitude of each face's centre, and the azimuth there of its first axis, in radians.
FACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882), (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055), (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400), (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874), (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154), (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562), (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361), (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535), (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316), (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436), (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)
#: Fixed values of the grid: the distance of neighbouring base cells on a face's plane, and the turn of odd resolutions.
UNIT, TURN = 0.38196601125010500003, 0.333473172251832115336090755351601070065900389
#: Fixed values of the grid: own faces of the base cells that lie on edges and on vertices, each from north to south.
EDGE_FACES = (2, 1, 1, 3, 2, 0, 4, 0, 11, 6, 7, 3, 10, 4, 12, 5, 16, 8, 15, 14, 13, 9, 17, 16, 17, 19, 15, 18, 18, 19)
VERTEX_FACES = (0, 11, 10, 12, 14, 13, 6, 7, 5, 8, 9, 19)
RESOLUTION, FINEST = 10, 15
#: Digits, 4 i + 2 j + k, after a sixth of a turn to the left: k, ik, i, ij, j, jk, k.
LEFT = np.array([0, 5, 3, 1, 6, 4, 2])
RIGHT = np.argsort(LEFT)
K_AXIS = 1


def directions(latitude: np.ndarray, longitude: np.ndarray) -> np.ndarray:
    return np.stack([np.cos(latitude) * np.cos(longitude), np.cos(latitude) * np.sin(longitude), np.sin(latitude)], axis=-1)


@cache
def face_axes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors (faces x 3): to a face's centre, along its first axis, and a quarter turn left of it."""
    latitude, longitude, azimuth = np.array(FACES).T
    centre = directions(latitude, longitude)
    north = directions(latitude + np.pi / 2, longitude)
    east = np.stack([-np.sin(longitude), np.cos(longitude), np.zeros(len(FACES))], axis=-1)
    along = np.cos(azimuth)[:, None] * north + np.sin(azimuth)[:, None] * east
    return centre, along, np.cross(centre, along)


def plane(ijk: np.ndarray) -> np.ndarray:
    """Coordinates on the plane; the axes are a third of a turn apart."""
    i, j, k = np.moveaxis(np.asarray(ijk, float), -1, 0)
    return np.stack([i - (j + k) / 2, np.sqrt(0.75) * (j - k)], axis=-1)


def on_sphere(face: int, xy: np.ndarray) -> np.ndarray:
    centre, along, left = face_axes()
    v = centre[face] + UNIT * (xy[0] * along[face] + xy[1] * left[face])
    return v / np.linalg.norm(v)


def on_plane(face: int, v: np.ndarray) -> np.ndarray:
    centre, along, left = face_axes()
    return np.array([v @ along[face], v @ left[face]]) / (v @ centre[face])


@cache
def base_cells() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the base cells from north to south: direction, own face, and whether it is a pentagon."""
    found: list[tuple[np.ndarray, int, int]] = []  # direction, number of the faces that it lies on, one of these
    for face in range(len(FACES)):
        for i, j, k in np.ndindex(3, 3, 3):
            if min(i, j, k) == 0 and i + j + k <= 2:
                v = on_sphere(face, plane((i, j, k)))
                at = next((n for n, (w, _, _) in enumerate(found) if v @ w > 1 - 1e-9), None)
                if at is None:
                    found.append((v, 1, face))
                else:
                    found[at] = (found[at][0], found[at][1] + 1, found[at][2])
    found.sort(key=lambda cell: -cell[0][2])
    edges, vertices = iter(EDGE_FACES), iter(VERTEX_FACES)
    own = [face if number == 1 else next(edges) if number == 2 else next(vertices) for _, number, face in found]
    return np.array([v for v, _, _ in found]), np.array(own), np.array([number == 5 for _, number, _ in found])


@cache
def reached() -> np.ndarray:
    """(faces x 3 x 3 x 3 x 3): base cell, turns to the axes of its own face, and for a pentagon whether the face has it on its second axis."""
    where, own, pentagon = base_cells()
    centre, _, _ = face_axes()
    out = np.zeros((len(FACES), 3, 3, 3, 3), np.int64)
    for face in range(len(FACES)):
        for ijk in np.ndindex(3, 3, 3):
            at = plane(ijk)
            v, beside = on_sphere(face, at), on_sphere(face, at + [1e-4, 0])
            cell = int((where @ v).argmax())
            home = own[cell]
            if pentagon[cell] and sorted(ijk) == [0, 0, 2]:
                axis = ijk.index(2)
                # fifths of a turn around the vertex from the own face's centre; turns skip the missing sixth
                one, other = (centre[f] - (centre[f] @ where[cell]) * where[cell] for f in (home, face))
                turned = np.arctan2(np.cross(one, other) @ where[cell], one @ other)
                fifth = round(turned / (2 * np.pi / 5)) % 5
                out[face][ijk] = cell, fifth if axis == 0 else (fifth - 2 * axis + 1) % 5, axis == 1
            else:
                x, y = on_plane(home, beside) - on_plane(home, v)
                out[face][ijk] = cell, round(np.arctan2(y, x) / (np.pi / 3)) % 6, 0
    return out


def normal(ijk: np.ndarray) -> np.ndarray:
    """The same place with its smallest coordinate zero."""
    return ijk - ijk.min(axis=-1, keepdims=True)


#: Where a child's axes lie on the finer grid, by rows, for odd and for even resolutions.
FINER = {1: np.array([[3, 0, 1], [1, 3, 0], [0, 1, 3]]), 0: np.array([[3, 1, 0], [0, 3, 1], [1, 0, 3]])}


def nearest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The hexagon that holds a point of the plane."""
    s = y / np.sqrt(0.75)
    p = x - s / 2
    cube = np.stack([p, s, -p - s], axis=-1)
    whole = np.rint(cube)
    off = np.abs(whole - cube)
    worst = off.argmax(axis=-1)
    rows = np.arange(len(whole))
    whole[rows, worst] -= whole.sum(axis=-1)
    p, s = whole[:, 0].astype(np.int64), whole[:, 1].astype(np.int64)
    return normal(np.stack([p + s, s, np.zeros_like(s)], axis=-1))


def parents(ijk: np.ndarray, odd: int) -> np.ndarray:
    """The hexagons of the next coarser grid in whose flower of seven the given ones lie."""
    i, j = ijk[:, 0] - ijk[:, 2], ijk[:, 1] - ijk[:, 2]
    up = (3 * i - j, i + 2 * j) if odd else (2 * i + j, 3 * j - i)
    sevenths = [np.floor_divide(2 * u + 7, 14) for u in up]
    return normal(np.stack([*sevenths, np.zeros_like(i)], axis=-1))


def turned(digits: np.ndarray, some: np.ndarray, how: np.ndarray) -> None:
    digits[some] = how[digits[some]]


def leading(digits: np.ndarray) -> np.ndarray:
    """The first digit of each row that isn't zero, or zero."""
    if not digits.shape[1]:
        return np.zeros(len(digits), np.int64)
    return digits[np.arange(len(digits)), (digits != 0).argmax(axis=1)]


def cells(latitude: np.ndarray, longitude: np.ndarray, resolution: int = RESOLUTION) -> np.ndarray:
    """The cell of each point, in degrees; 0 for one that isn't finite."""
    good = np.isfinite(latitude) & np.isfinite(longitude)
    points = directions(np.radians(np.where(good, latitude, 0)), np.radians(np.where(good, longitude, 0)))
    centre, along, left = face_axes()
    face = (points @ centre.T).argmax(axis=1)
    depth = np.einsum("ij,ij->i", points, centre[face])
    x, y = np.einsum("ij,ij->i", points, along[face]) / depth, np.einsum("ij,ij->i", points, left[face]) / depth
    scale, angle = np.sqrt(7.0) ** resolution / UNIT, TURN * (resolution % 2)
    x, y = scale * (x * np.cos(angle) + y * np.sin(angle)), scale * (y * np.cos(angle) - x * np.sin(angle))
    at = nearest(x, y)
    digits = np.zeros((len(at), resolution), np.int64)
    for r in range(resolution, 0, -1):
        up = parents(at, r % 2)
        digits[:, r - 1] = normal(at - up @ FINER[r % 2]) @ [4, 2, 1]
        at = up
    cell, turns, second = np.moveaxis(reached()[face, at[:, 0], at[:, 1], at[:, 2]], -1, 0)
    fives = base_cells()[2][cell]
    # a pentagon has no child on its third axis: what fell there belongs to a neighbour
    lost = fives & (leading(digits) == K_AXIS)
    turned(digits, lost & (second == 1), RIGHT)
    turned(digits, lost & (second == 0), LEFT)
    for n in range(1, 6):
        some = turns >= n
        turned(digits, some, LEFT)
        turned(digits, some & fives & (leading(digits) == K_AXIS), LEFT)
    out = (np.int64(1) << 59) | (np.int64(resolution) << 52) | (cell << 45)
    for r in range(1, FINEST + 1):
        out |= (digits[:, r - 1] if r <= resolution else np.int64(7)) << (3 * (FINEST - r))
    return np.where(good, out, 0)


def cell_of(resolution: int):
    @F.arrow_udf("bigint")
    def cell(latitude: pa.Array, longitude: pa.Array) -> pa.Array:
        found = cells(*(x.cast(pa.float64()).to_numpy(zero_copy_only=False) for x in (latitude, longitude)), resolution)
        return pa.array(found, mask=found == 0)

    return cell


def h3(latitude: Column, longitude: Column, resolution: int = RESOLUTION) -> Column:
    """The cell of a place in degrees as a number; null if a coordinate is null, not finite or out of range."""
    inside = latitude.between(-90, 90) & longitude.between(-180, 180)
    return cell_of(resolution)(F.when(inside, latitude.cast("double")), F.when(inside, longitude.cast("double")))
