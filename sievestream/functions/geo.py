"""Bounding boxes, points and polygon rings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The error texts of rule validation.
OUT_OF_RANGE = "Lat/lon out of range: "
NOT_ENOUGH = "not enough values to unpack (expected {}, got "
TOO_MANY = "too many values to unpack (expected {})"
NOT_A_FLOAT = "could not convert string to float: '"
RING_NOT_LIST = "Linear ring in coordinates is not a list"
RING_EMPTY = "Linear ring in coordinates is empty"
RING_SHORT = "Linear ring in coordinates is too short"
TYPE_UNKNOWN = "GeoJSON type not supported: "
NO_GEOMETRY = "Invalid GeoJSON object"
GEOMETRY_UNKNOWN = "GeoJSON geometry type not supported: "
NO_COORDINATES = "GeoJSON coordinates list is empty."

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def to_number(text: Column) -> Column:
    """Text as DOUBLE; NULL where it is not a plain number."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def in_range(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def box(value: Column) -> Column:
    """`lon1,lat1,lon2,lat2` as a struct, NULL unless it is four numbers."""
    parts = F.transform(F.split(value, ","), to_number)
    ok = (F.size(parts) == 4) & ~F.exists(parts, lambda p: p.isNull())
    return F.when(
        ok,
        F.struct(
            F.get(parts, 0).alias("lon1"),
            F.get(parts, 1).alias("lat1"),
            F.get(parts, 2).alias("lon2"),
            F.get(parts, 3).alias("lat2"),
        ),
    )


def message_area(message: str = "message") -> Column:
    """The box a message lies in: its point when it has one, else the hull of its place polygon."""
    point = F.col(f"{message}.coordinates.coordinates")
    ring = F.get(F.col(f"{message}.place.bounding_box.coordinates"), 0)
    lons, lats = F.transform(ring, lambda p: F.get(p, 0)), F.transform(ring, lambda p: F.get(p, 1))
    names = ("lon1", "lat1", "lon2", "lat2")
    at_point = [F.get(point, 0), F.get(point, 1), F.get(point, 0), F.get(point, 1)]
    hull = [F.array_min(lons), F.array_min(lats), F.array_max(lons), F.array_max(lats)]
    return F.when(point.isNotNull(), F.struct(*[c.alias(n) for c, n in zip(at_point, names)])).when(
        ring.isNotNull(), F.struct(*[c.alias(n) for c, n in zip(hull, names)])
    )


def overlaps(area: Column, other: Column) -> Column:
    return (
        (area["lon1"] <= other["lon2"])
        & (area["lon2"] >= other["lon1"])
        & (area["lat1"] <= other["lat2"])
        & (area["lat2"] >= other["lat1"])
    )


#: Levels of the cells: on level k the world is cut into 2 ** k by 2 ** k of them.
CELL_LEVELS = 16
#: A box is covered by at most this many cells.
MAX_CELLS = 16


def _span(area: Column, axis: str, level: Column) -> tuple[Column, Column]:
    """First and last cell on a level along an axis. Corners in the wrong order are swapped; border cells take what lies outside."""
    limit = 180.0 if axis == "lon" else 90.0
    cells = F.pow(F.lit(2.0), level)

    def place(x: Column) -> Column:
        return F.least(cells - 1, F.greatest(F.lit(0.0), F.floor((x + limit) / (2 * limit) * cells))).cast("long")

    one, two = area[f"{axis}1"], area[f"{axis}2"]
    return place(F.least(one, two)), place(F.greatest(one, two))


def cell_level(area: Column) -> Column:
    """The finest level on which at most MAX_CELLS cells cover an area; null for an area without numbers."""

    def few(level: Column) -> Column:
        (west, east), (south, north) = _span(area, "lon", level), _span(area, "lat", level)
        return (east - west + 1) * (north - south + 1) <= MAX_CELLS

    return F.array_max(F.filter(F.sequence(F.lit(0), F.lit(CELL_LEVELS)), few))


def cells(area: Column, own: Column, others: list[int]) -> Column:
    """The cells that cover an area on its own level, and those above them on the coarser ones of `others`.

    So two areas that touch share a cell whenever each is given the levels that the other side has: on the coarser one of their own levels.
    """

    def on(level: Column) -> Column:
        (west, east), (south, north) = _span(area, "lon", level), _span(area, "lat", level)
        columns, rows = F.sequence(west, east), F.sequence(south, north)
        cell = lambda x, y: F.struct(level.cast("int").alias("level"), x.alias("x"), y.alias("y"))
        return F.flatten(F.transform(columns, lambda x: F.transform(rows, lambda y: cell(x, y))))

    coarser = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda level: level < own)
    return F.array_distinct(F.flatten(F.transform(F.concat(coarser, F.array(own.cast("int"))), on)))


def legacy_box_error(value: Column) -> Column:
    """Why a `lon1,lat1,lon2,lat2` rule value is not usable; NULL when it is."""
    parts = F.split(value, ",")
    size = F.size(parts)

    def pair_error(lon: Column, lat: Column) -> Column:
        out_of_range = F.concat(F.lit(OUT_OF_RANGE), lat, F.lit(", "), lon)
        return (
            F.when(_not_float(lat), _float_error(lat))
            .when(~F.coalesce(to_number(lat).between(-90, 90), F.lit(False)), out_of_range)
            .when(_not_float(lon), _float_error(lon))
            .when(~F.coalesce(to_number(lon).between(-180, 180), F.lit(False)), out_of_range)
        )

    first = pair_error(F.get(parts, 0), F.get(parts, 1))
    second = pair_error(F.get(parts, 2), F.get(parts, 3))
    stops = _not_float(F.get(parts, 1)) | (to_number(F.get(parts, 1)).between(-90, 90) & _not_float(F.get(parts, 0)))
    return (
        F.when(size < 4, F.concat(F.lit(NOT_ENOUGH.format(4)), size, F.lit(")")))
        .when(size > 4, F.lit(TOO_MANY.format(4)))
        .when(F.coalesce(stops, F.lit(False)), first)
        .otherwise(F.coalesce(second, first))
    )


def _not_float(text: Column) -> Column:
    return ~(text.rlike(_NUMBER) | text.rlike(_SPECIAL))


def _float_error(text: Column) -> Column:
    return F.concat(F.lit(NOT_A_FLOAT), text, F.lit("'"))


# Coordinates are read as text so that messages quote them as written.
GEOJSON_DDL = "type STRING, geometry STRUCT<type: STRING, coordinates: ARRAY<ARRAY<ARRAY<STRING>>>>"


def _same_position(a: Column, b: Column) -> Column:
    numbers = lambda p: F.transform(p, lambda x: x.try_cast("double"))
    return numbers(a) == numbers(b)


def without_repeats(ring: Column) -> Column:
    return F.filter(ring, lambda p, i: (i == 0) | ~_same_position(p, F.get(ring, i - 1)))


def closed(ring: Column) -> Column:
    open_ring = (F.size(ring) >= 3) & ~_same_position(F.get(ring, 0), F.element_at(ring, -1))
    return F.when(open_ring, F.concat(ring, F.array(F.get(ring, 0)))).otherwise(ring)


def _position_error(position: Column) -> Column:
    size = F.size(position)
    lon, lat = F.get(position, 0), F.get(position, 1)
    return (
        F.when(size > 2, F.lit(TOO_MANY.format(2)))
        .when(size < 2, F.concat(F.lit(NOT_ENOUGH.format(2)), size, F.lit(")")))
        .when(
            ~in_range(lat.try_cast("double"), lon.try_cast("double")),
            F.concat(F.lit(OUT_OF_RANGE), F.coalesce(lat, F.lit("None")), F.lit(", "), F.coalesce(lon, F.lit("None"))),
        )
    )


def _ring_error(ring: Column) -> Column:
    bad = F.filter(F.transform(without_repeats(ring), _position_error), lambda e: e.isNotNull())
    return (
        F.when(ring.isNull(), F.lit(RING_NOT_LIST))
        .when(F.size(ring) == 0, F.lit(RING_EMPTY))
        .when(F.size(bad) > 0, F.get(bad, 0))
        .when(F.size(closed(without_repeats(ring))) < 4, F.lit(RING_SHORT))
    )


def geojson_error(feature: Column) -> Column:
    """Why a GeoJSON feature is not a usable polygon; NULL when it is."""
    kind, geometry = feature["type"], feature["geometry"]
    rings = geometry["coordinates"]
    ring_errors = F.filter(F.transform(rings, _ring_error), lambda e: e.isNotNull())
    return (
        F.when(
            F.coalesce(F.lower(kind), F.lit("")) != "feature",
            F.concat(F.lit(TYPE_UNKNOWN), F.coalesce(kind, F.lit("None"))),
        )
        .when(geometry.isNull(), F.lit(NO_GEOMETRY))
        .when(
            F.coalesce(F.lower(geometry["type"]), F.lit("")) != "polygon",
            F.concat(F.lit(GEOMETRY_UNKNOWN), kind),
        )
        .when(rings.isNull() | (F.size(rings) == 0), F.lit(NO_COORDINATES))
        .otherwise(F.get(ring_errors, 0))
    )


def repaired_rings(feature: Column) -> Column:
    """The polygon's rings without consecutive repeats, closed, as numbers."""
    rings = F.transform(feature["geometry"]["coordinates"], lambda ring: closed(without_repeats(ring)))
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.transform(p, lambda x: x.try_cast("double"))))
