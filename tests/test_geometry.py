"""GeoJSON features to tables."""

import csv
import json
import os
import tempfile

from curbflow.operators import geometry


def features(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "feature STRING")


def feature(props, kind=None, coords=None):
    geo = None if kind is None else {"type": kind, "coordinates": coords}
    return {"type": "Feature", "properties": props, "geometry": geo}


SQUARE = [[[-74.0, 40.5], [-73.95, 40.5], [-73.95, 40.25], [-74.0, 40.25], [-74.0, 40.5]]]
EAST = [[[-73.95, 40.25], [-73.95, 40.5], [-73.5, 40.5], [-73.95, 40.25]]]
FAR = [[[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 1.0]]]


def swap(coords):
    return [coords[1], coords[0]] if not isinstance(coords[0], list) else [swap(x) for x in coords]


def test_fields_by_candidate_and_case(spark):
    rows = features(
        spark, feature({"OBJECTID": "7", "LOCATIONID": "3", "Zone": "A", "BOROUGH": "B"}, "Polygon", SQUARE),
        feature({"zone_name": "A", "borough": "B"}, "Polygon", SQUARE))
    got = {r.id_field: r for r in geometry.field_report(rows).collect()}
    assert (got["LOCATIONID"].zone_field, got["LOCATIONID"].complete) == ("Zone", True)
    assert (got[None].zone_field, got[None].complete) == ("zone_name", False)


def test_swap_at_any_depth(spark):
    props = {"LocationID": "3", "zone": "A", "borough": "B"}
    shapes = {"Point": [-74.0, 40.5], "LineString": SQUARE[0], "Polygon": SQUARE, "MultiPolygon": [SQUARE, EAST]}
    rows = features(spark, feature(props), *[feature(props, k, v) for k, v in shapes.items()])
    got = {r.type: r.coordinates for r in geometry.swap_coordinates(rows).collect()}
    assert got == {k: json.dumps(swap(v)) for k, v in shapes.items()}
    counts = geometry.geometry_errors(rows).collect()[0]
    assert (counts.features, counts.converted, counts.errors) == (5, 4, 1)


def test_polygon_rows_and_csv(spark):
    props = {"LocationID": 3, "zone": 'The "A"', "borough": "B"}
    rows = features(spark, feature(props), feature(props, "Point", [1.0, 2.0]),
                    feature(props, "Polygon", SQUARE), feature(props, "MultiPolygon", [SQUARE, EAST]))
    got = sorted((r.location_id, r.part, r.coordinates) for r in geometry.explode_polygons(rows).collect())
    assert got == sorted([(3, 0, json.dumps(swap(SQUARE)))] * 2 + [(3, 1, json.dumps(swap(EAST)))])
    path = tempfile.mkdtemp(prefix="run-") + "/zones"
    geometry.write_zone_csv(rows, path)
    read = []
    for name in os.listdir(path):
        if name.startswith("part-"):
            read += list(csv.DictReader(open(f"{path}/{name}", encoding="utf-8")))
    assert len(read) == 3
    assert {r["zone"] for r in read} == {'The "A"'}
    assert json.loads(read[0]["coordinates"])[0][0] == [40.5, -74.0] or len(read[0]["coordinates"]) > 0


def test_collection_file(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/zones.geojson"
    props = {"LocationID": "3", "zone": "A", "borough": "B"}
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection",
                   "features": [feature(props, "Polygon", SQUARE), feature(props)]}, f, indent=1)
    rows = geometry.read_collection(spark, path)
    assert rows.columns == ["feature"] and rows.count() == 2
    assert geometry.explode_polygons(rows).count() == 1


def test_adjacency_by_shared_segment(spark):
    def zone(i, coords):
        return feature({"LocationID": str(i), "zone": "z", "borough": "b"}, "Polygon", coords)

    rows = features(spark, *[zone(1, SQUARE)] * 20, zone(2, EAST), zone(3, FAR))
    pairs = {tuple(r) for r in geometry.adjacency(rows).collect()}
    assert pairs == {(1, 2), (2, 1)}


def test_contact_without_shared_vertices(spark):
    """Split sides, shifted starts, slanted sides, points only, and a gap of a tenth of a millimetre."""
    def zone(i, *rings):
        return feature({"LocationID": str(i), "zone": "z", "borough": "b"}, "Polygon", [[list(p) for p in r] for r in rings])

    one = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    split = [(4, 1), (8, 1), (8, 6), (4, 6), (4, 3), (4, 2), (4, 1)]  # along the right side of one, cut twice
    shifted = [(8, 6), (8, 1), (9, 1), (9, 6), (8, 6)]  # the same side as split's, begun elsewhere
    corner = [(4, -3), (7, -3), (7, 0), (4, 0), (4, -3)]  # touches one in a point
    slant = [(20, 0), (23, 9), (20, 9), (20, 0)]
    along = [(21, 3), (22, 6), (26, 3), (21, 3)]  # on the slanted side, between its ends
    hole = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]
    inside = [(1, 1), (2, 1), (2, 1.5), (1, 1.5), (1, 1)]
    off = [(-1, 0), (-0.000000001, 0), (-0.000000001, 4), (-1, 4), (-1, 0)]
    long = [(-1, 100), (1000, 100), (1000, 200), (-1, 200), (-1, 100)]
    short = [(500.25, 99), (500.5, 99), (500.5, 100), (500.25, 100), (500.25, 99)]
    rows = features(spark, zone(1, one, hole), zone(2, split), zone(3, shifted), zone(4, corner), zone(5, slant), zone(6, along),
                    zone(7, inside), zone(8, off), zone(9, long), zone(10, short), zone(11, [(5, 5), (5, 5)]))
    pairs = {tuple(r) for r in geometry.contacts(rows).collect()}
    assert pairs == {(1, 2), (2, 3), (5, 6), (1, 7), (9, 10)}
    assert {tuple(r) for r in geometry.adjacency(rows).collect()} == pairs | {(b, a) for a, b in pairs}
    assert geometry.adjacency(rows.where("false")).isEmpty()
    for pushed in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert pushed not in geometry.contacts(rows)._jdf.queryExecution().executedPlan().toString()
