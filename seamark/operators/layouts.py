"""Bit layouts of AIS messages as data; ``decode`` turns them into expressions.

Each entry is offset/width, with s for signed numbers. The layouts are those of the public message standard.
"""

from __future__ import annotations

# Field; then for each group of message types, the types and the place.
POSITION = """
nav        1,2,3 38/4   27 40/4
rot        1,2,3 42/8s
sog        1,2,3,9 50/10   18,19 46/10   27 79/6
accuracy   1,2,3,9 60/1   4 78/1   18,19 56/1   27 38/1
lon        1,2,3,9 61/28s   4 79/28s   18,19 57/28s   27 44/18s
lat        1,2,3,9 89/27s   4 107/27s   18,19 85/27s   27 62/17s
cog        1,2,3,9 116/12   18,19 112/12   27 85/9
heading    1,2,3 128/9   18,19 124/9
manoeuvre  1,2,3 143/2
raim       1,2,3 148/1   4 148/1   9,18 147/1   19 305/1   27 39/1
altitude   9 38/12
"""

# As above; text fields give their characters after the offset with a c.
STATIC = """
imo          5 40/30
call_sign    5 70/7c   24 90/7c
name         5 112/20c   24 40/20c
ship_type    5 232/8   24 40/8
bow          5 240/9   24 132/9
stern        5 249/9   24 141/9
port         5 258/6   24 150/6
starboard    5 264/6   24 156/6
eta_month    5 274/4
eta_day      5 278/5
eta_hour     5 283/5
eta_minute   5 288/6
draught      5 294/8
destination  5 302/20c
part         24 38/2
mothership   24 132/30
"""

# Fixed values.
ATON = """
aid_type      21 38/5
name          21 43/20c
lon           21 164/28s
lat           21 192/27s
bow           21 219/9
stern         21 228/9
port          21 237/6
starboard     21 243/6
off_position  21 259/1
raim          21 268/1
virtual       21 269/1
assigned      21 270/1
"""

# Field; place, value for "not available" and formula in the layout of identifier 31; the same for identifier 11.
# A formula is added to, then divided by; - is a field that the layout lacks.
METEO = """
longitude                  56/25s 10860000 0 60000       80/25s 16777215 0 60000
latitude                   81/24s 5460000 0 60000        56/24s 8388607 0 60000
position_accuracy          105/1 none 0 1                -
day                        106/5 0 0 1                   105/5 0 0 1
hour                       111/5 24 0 1                  110/5 24 0 1
minute                     116/6 60 0 1                  115/6 60 0 1
wind_speed_kn              122/7 127 0 1                 121/7 127 0 1
wind_gust_kn               129/7 127 0 1                 128/7 127 0 1
wind_dir_deg               136/9 360 0 1                 135/9 511 0 1
wind_gust_dir_deg          145/9 360 0 1                 144/9 511 0 1
air_temp_c                 154/11s -1024 0 10            153/11 2047 -600 10
humidity_pct               165/7 101 0 1                 164/7 127 0 1
dew_point_c                172/10s 501 0 10              171/10 1023 -200 10
pressure_hpa               182/9 511 799 1               181/9 511 800 1
pressure_tendency          191/2 3 0 1                   190/2 3 0 1
visibility_nm              194/7 127 0 10                192/8 255 0 10
visibility_greater         193/1 none 0 1                -
water_level_m              201/12 4001 -1000 100         200/9 511 -100 10
water_level_trend          213/2 3 0 1                   209/2 3 0 1
surface_current_speed_kn   215/8 255 0 10                211/8 255 0 10
surface_current_dir_deg    223/9 360 0 1                 219/9 511 0 1
current2_speed_kn          232/8 255 0 10                228/8 255 0 10
current2_dir_deg           240/9 360 0 1                 236/9 511 0 1
current2_depth_m           249/5 31 0 10                 245/5 31 0 10
current3_speed_kn          254/8 255 0 10                250/8 255 0 10
current3_dir_deg           262/9 360 0 1                 258/9 511 0 1
current3_depth_m           271/5 31 0 10                 267/5 31 0 10
wave_height_m              276/8 255 0 10                272/8 255 0 10
wave_period_s              284/6 63 0 1                  280/6 63 0 1
wave_dir_deg               290/9 360 0 1                 286/9 511 0 1
swell_height_m             299/8 255 0 10                295/8 255 0 10
swell_period_s             307/6 63 0 1                  303/6 63 0 1
swell_dir_deg              313/9 360 0 1                 309/9 511 0 1
sea_state                  322/4 15 0 1                  318/4 15 0 1
water_temp_c               326/10s 501 0 10              322/10 1023 -100 10
precipitation_type         336/3 7 0 1                   332/3 7 0 1
salinity_pct               339/9 >=510 0 10              335/9 >=511 0 10
ice                        348/2 3 0 1                   344/2 3 0 1
"""
FLAGS = ("position_accuracy", "visibility_greater")


def by_type(table: str) -> dict[str, list[tuple[tuple[int, ...], int, int, str]]]:
    """field -> [(types, offset, width, kind)], kind "", "s" or "c"."""
    found = {}
    for line in table.strip().split("\n"):
        name, *rest = line.split()
        places = []
        for types, place in zip(rest[::2], rest[1::2], strict=True):
            offset, width = place.split("/")
            places.append((tuple(map(int, types.split(","))), int(offset), int(width.rstrip("sc")), width.lstrip("0123456789")))
        found[name] = places
    return found


def meteo(identifier: int) -> dict[str, tuple[int, int, str, str, int, int] | None]:
    """field -> (offset, width, kind, missing, added, divided) for identifier 31 or 11."""
    found = {}
    for line in METEO.strip().split("\n"):
        name, *rest = line.split()
        groups = [rest[:4], rest[4:]]
        place, *formula = groups[0 if identifier == 31 else 1]
        if place == "-":
            found[name] = None
        else:
            offset, width = place.split("/")
            found[name] = (int(offset), int(width.rstrip("s")), width.lstrip("0123456789"), formula[0], int(formula[1]), int(formula[2]))
    return found
