"""Space-filling keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 31
#: Bits of x and of y that a step reads.
AT_ONCE = 4
SWAPPED, MIRRORED = 1, 2


def quadrant_steps() -> list[int]:
    """For each way the rest lies (SWAPPED, MIRRORED), and the next bits of x and of y: the digits of the place, times 4, and how the rest then lies."""
    found = []
    for lies in range(4):
        for x in range(1 << AT_ONCE):
            for y in range(1 << AT_ONCE):
                digits, now = 0, lies
                for k in reversed(range(AT_ONCE)):
                    rx, ry = x >> k & 1, y >> k & 1
                    if now & SWAPPED:
                        rx, ry = ry, rx
                    if now & MIRRORED:
                        rx, ry = 1 - rx, 1 - ry
                    digits = 4 * digits + (3 * rx ^ ry)
                    if not ry:
                        now ^= SWAPPED | MIRRORED * rx
                found.append(4 * digits + now)
    return found


def grid(degrees: Column, half: float) -> Column:
    """Degrees from -half to half as a cell number; the upper edge falls into the last cell."""
    return F.least(F.floor((degrees + half) / (2 * half) * float(1 << BITS)), F.lit((1 << BITS) - 1)).cast("long")


def hilbert(latitude: Column, longitude: Column) -> Column:
    """Place on a Hilbert curve over 2^31 by 2^31 cells; null outside the map.

    Each step reads AT_ONCE bits of x and y from the top and looks up the digits that they append to the place, and
    whether the rest of the coordinates is swapped and mirrored. A bit of zeros is read before the first one, which
    swaps, so the walk begins swapped.
    """
    inside = latitude.between(-90, 90) & longitude.between(-180, 180)
    table = F.expr(f"array({', '.join(map(str, quadrant_steps()))})")
    mask = F.lit((1 << AT_ONCE) - 1).cast("long")
    cell = F.struct(grid(longitude, 180.0).alias("x"), grid(latitude, 90.0).alias("y"))

    def walk(at: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            x, y = (F.call_function("shiftright", at[n], k).bitwiseAND(mask) for n in "xy")
            # the last two bits of acc tell how the rest lies; the digits of the place are above them
            found = F.get(table, (acc.bitwiseAND(F.lit(3)) * (1 << 2 * AT_ONCE) + x * (1 << AT_ONCE) + y).cast("int"))
            return F.shiftleft(F.shiftrightunsigned(acc, 2), 2 * AT_ONCE + 2).bitwiseOR(found.cast("long"))

        steps = F.sequence(F.lit(BITS + 1 - AT_ONCE), F.lit(0), F.lit(-AT_ONCE))
        return F.aggregate(steps, F.lit(SWAPPED).cast("long"), step, lambda acc: F.shiftrightunsigned(acc, 2))

    return F.when(inside, F.element_at(F.transform(F.array(cell), walk), 1))
