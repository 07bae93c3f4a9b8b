"""Zone geometry: GeoJSON features, one text per row, to map-ready tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

c = F.col

# Property names under which sources publish the three fields.
CANDIDATES = {
    "id": ["locationid", "location_id", "objectid"],
    "zone": ["zone", "zone_name"],
    "borough": ["borough"],
}
FEATURE = "properties MAP<STRING, STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"
# Nesting of the coordinates of each geometry type.
DEPTH = {
    "Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3,
    "MultiPolygon": 4,
}


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """Features of FeatureCollection files, one JSON text per row."""
    whole = spark.read.schema("features ARRAY<STRING>").json(path, multiLine=True)
    return whole.select(F.explode("features").alias("feature"))


def parse(features: DataFrame, text: str = "feature") -> DataFrame:
    """Adds ``properties`` and ``geometry`` parsed from the feature text."""
    return features.withColumn("f", F.from_json(text, FEATURE)).select(
        *features.columns, "f.properties", "f.geometry"
    )


def field_name(kind: str) -> Column:
    """The property that holds a field: first candidate present, any letter case."""
    def spelled(candidate: str) -> Column:
        same = F.filter(F.map_keys("properties"), lambda k: F.lower(k) == candidate)
        return F.try_element_at(same, F.lit(-1))

    return F.coalesce(*[spelled(x) for x in CANDIDATES[kind]])


def _field(kind: str) -> Column:
    return F.try_element_at("properties", field_name(kind))


def field_report(features: DataFrame) -> DataFrame:
    """Which property names were found, how often, and whether any is absent."""
    names = parse(features).select(
        *[field_name(k).alias(f"{k}_field") for k in CANDIDATES],
    )
    missing = reduce(lambda a, b: a | b, [c(x).isNull() for x in names.columns])
    return names.withColumn("complete", ~missing).groupBy(*names.columns, "complete").agg(
        F.count(F.lit(1)).alias("features")
    )


def _nested(depth: int) -> str:
    return "ARRAY<" * depth + "STRING" + ">" * depth


def _swapped(coords: Column, depth: int) -> Column:
    """JSON text of nested [lon, lat] arrays as [lat, lon], numbers kept as written."""
    if depth == 1:
        return F.concat(F.lit("["), coords[1], F.lit(", "), coords[0], F.lit("]"))
    inner = F.transform(coords, lambda x: _swapped(x, depth - 1))
    return F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]"))


def _zone_columns() -> list[Column]:
    return [
        _field("id").cast("int").alias("location_id"),
        _field("zone").alias("zone"), _field("borough").alias("borough"),
    ]


def swap_coordinates(features: DataFrame) -> DataFrame:
    """One row per feature with a geometry, all its coordinates as [lat, lon] text."""
    kind, raw = c("geometry.type"), c("geometry.coordinates")
    text = F
    for name, depth in DEPTH.items():
        text = text.when(kind == name, _swapped(F.from_json(raw, _nested(depth)), depth))
    parsed = parse(features).where(c("geometry").isNotNull())
    return parsed.select(*_zone_columns(), kind.alias("type"), text.alias("coordinates"))


def geometry_errors(features: DataFrame) -> DataFrame:
    """Features converted, and those without a geometry or with one of an unknown type."""
    known = F.coalesce(c("geometry.type").isin(*DEPTH), F.lit(False))
    return parse(features).agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if(known).alias("converted"),
        F.count_if(~known).alias("errors"),
    )


def polygons(features: DataFrame) -> DataFrame:
    """One row per polygon, rings as nested arrays of number texts in file order.

    A MultiPolygon gives a row per part; no geometry and other types give none.
    """
    kind, raw = c("geometry.type"), c("geometry.coordinates")
    parts = (
        F.when(kind == "Polygon", F.array(F.from_json(raw, _nested(3))))
        .when(kind == "MultiPolygon", F.from_json(raw, _nested(4)))
    )
    return parse(features).select(*_zone_columns(), F.posexplode(parts).alias("part", "rings"))


def explode_polygons(features: DataFrame) -> DataFrame:
    return polygons(features).select(
        "location_id", "zone", "borough", "part", _swapped(c("rings"), 3).alias("coordinates")
    )


def write_zone_csv(features: DataFrame, path: str) -> None:
    """The map layer as CSV: LocationID, zone, borough, coordinates."""
    explode_polygons(features).select(
        c("location_id").alias("LocationID"), "zone", "borough", "coordinates"
    ).write.mode("overwrite").csv(path, header=True, escape='"')


#: Coordinates are compared as whole numbers of this part of a degree (a tenth of a millimetre).
UNIT = 9


def _segments(features: DataFrame) -> DataFrame:
    """(zone_id, x1, y1, x2, y2) of all outline segments, holes included, each once, ends in order; whole numbers."""
    ring = c("ring")
    last = F.size(ring) - 2
    ends = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_sort(F.array(_point(F.get(ring, i)), _point(F.get(ring, i + 1)))),
    )
    rings = polygons(features).select(c("location_id").alias("zone_id"), F.explode("rings").alias("ring"))
    sides = rings.select("zone_id", F.explode(ends).alias("s")).select(
        "zone_id", c("s")[0]["x"].alias("x1"), c("s")[0]["y"].alias("y1"), c("s")[1]["x"].alias("x2"), c("s")[1]["y"].alias("y2")
    )
    return sides.where("x1 <> x2 OR y1 <> y2").distinct()


def _point(p: Column) -> Column:
    def whole(i: int) -> Column:
        return F.round(F.get(p, F.lit(i)).cast(f"decimal(38,{UNIT + 6})") * 10**UNIT, 0).cast("bigint")

    return F.struct(whole(0).alias("x"), whole(1).alias("y"))


def _cells(level: Column) -> Column:
    """Cells of a grid of 2^level wide squares that the box of a segment touches: four at most at its own level."""
    def span(a: str, b: str) -> Column:
        return F.sequence(F.call_function("shiftright", F.least(a, b), level), F.call_function("shiftright", F.greatest(a, b), level))

    return F.flatten(F.transform(span("x1", "x2"), lambda x: F.transform(span("y1", "y2"), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def contacts(features: DataFrame, scratch: str | None = None) -> DataFrame:
    """(zone_id, neighbour_id) with zone_id the lesser: zones whose outlines run along each other for some length.

    Vertices need not be shared: a side may be cut at other points, or begin elsewhere. Every segment lies in
    a grid as coarse as it is long, so it has four cells there at most. It looks for others in its own grid and in
    those of longer segments; pairs of a cell are on one line if their cross products vanish, exactly.
    The segments, which are used three times, are kept in the folder ``scratch`` if one is given: the features
    are parsed once then.
    """
    sides = _segments(features)
    if scratch:
        sides.write.parquet(scratch)
        sides = features.sparkSession.read.schema(sides.schema).parquet(scratch)
    # bits of the longer extent: a box of 2^level covers the segment
    level = F.ceil(F.log2(F.greatest(F.abs(c("x2") - c("x1")), F.abs(c("y2") - c("y1"))).cast("double") + 1)).cast("int")
    sides = sides.withColumn("level", level)
    levels = F.array(*[F.lit(r[0]) for r in sides.select("level").distinct().collect()] or [F.lit(None).cast("int")])  # 40 at most
    named = ["zone_id", "x1", "y1", "x2", "y2"]
    home = sides.select(*[c(x).alias(f"h_{x}") for x in named], c("level").alias("at"), F.explode(_cells(c("level"))).alias("cell"))
    probe = sides.select(*named, "level", F.explode(F.filter(levels, lambda k: k >= c("level"))).alias("at"))
    probe = probe.select(*named, "at", F.explode(_cells(c("at"))).alias("cell"))
    met = probe.join(home, ["at", "cell"]).where("zone_id <> h_zone_id")

    def cross(ax: str, ay: str, bx: str, by: str) -> Column:
        wide = lambda x: F.expr(x).cast("decimal(18,0)")
        return wide(ax) * wide(by) - wide(ay) * wide(bx)

    one_line = (cross("x2 - x1", "y2 - y1", "h_x1 - x1", "h_y1 - y1") == 0) & (cross("x2 - x1", "y2 - y1", "h_x2 - x1", "h_y2 - y1") == 0)
    # ends are in order, so along the line the overlap is between the greater beginning and the lesser end
    along = F.greatest(F.struct("x1", "y1"), F.struct(c("h_x1").alias("x1"), c("h_y1").alias("y1"))) < F.least(
        F.struct(c("x2").alias("x1"), c("y2").alias("y1")), F.struct(c("h_x2").alias("x1"), c("h_y2").alias("y1"))
    )
    return met.where(one_line & along).select(
        F.least("zone_id", "h_zone_id").alias("zone_id"), F.greatest("zone_id", "h_zone_id").alias("neighbour_id")
    ).distinct()


def adjacency(features: DataFrame, scratch: str | None = None) -> DataFrame:
    """(zone_id, neighbour_id), both ways, of zones whose outlines touch along a line; ``scratch`` as for :func:`contacts`."""
    there, back = F.struct("zone_id", "neighbour_id"), F.struct(c("neighbour_id").alias("zone_id"), c("zone_id").alias("neighbour_id"))
    return contacts(features, scratch).select(F.explode(F.array(there, back)).alias("p")).select("p.*")
