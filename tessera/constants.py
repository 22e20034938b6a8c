"""Fixed values that must equal the reference's for equal results."""

# --- fixed values -----------------------------------------------------------
# Metres per degree at the equator, used in the cos-latitude area rule.
DEG_TO_M = 111_320.0
# Height sentinel meaning "no height".
HEIGHT_NODATA = -999.0
# Default resolutions of the cell index.
DEFAULT_RESOLUTIONS = (3, 4, 5, 6, 7, 8)
# Pyramid zoom range and the row-count above which a zoom is split in 16.
DEFAULT_MINZOOM = 2
DEFAULT_MAXZOOM = 14
LARGE_ZOOM_ROWS = 100_000_000
# Row-group sizes and compression of the two outputs.
INDEX_ROW_GROUP = 1_000_000
PYRAMID_ROW_GROUP = 131_072
COMPRESSION = "zstd"
# Web-Mercator latitude limit.
MERCATOR_MAX_LAT = 85.05112878
# Continent boxes, in evaluation order: (name, lat_lo, lat_hi, lon_lo, lon_hi).
CONTINENT_BOXES = (
    ("Africa", -35, 37, -20, 55),
    ("Asia", 5, 55, 60, 150),
    ("Europe", 35, 72, -12, 45),
    ("South America", -56, 15, -82, -34),
    ("North America", 15, 72, -170, -50),
)
CONTINENT_OTHER = "Other"
# v2 index columns in output order.
INDEX_COLUMNS = (
    "h3_index",
    "building_count",
    "building_density",
    "total_footprint_m2",
    "coverage_ratio",
    "avg_height_m",
    "max_height_m",
    "height_std_m",
    "total_volume_m3",
    "volume_density_m3_per_km2",
    "avg_footprint_m2",
)
# What the index columns hold, for its metadata: type and text.
INDEX_COLUMN_TEXTS = {
    "h3_index": ["BIGINT", "cell id"],
    "building_count": ["INT", "buildings whose centroid lies in the cell"],
    "building_density": ["FLOAT", "buildings per km2"],
    "total_footprint_m2": ["FLOAT", "sum of footprint areas, m2"],
    "coverage_ratio": ["FLOAT", "share of the cell area under footprints"],
    "avg_height_m": ["FLOAT", "mean height of buildings with a height, m"],
    "max_height_m": ["FLOAT", "largest height, m"],
    "height_std_m": ["FLOAT", "population standard deviation of heights, m"],
    "total_volume_m3": ["FLOAT", "sum of footprint times height, m3"],
    "volume_density_m3_per_km2": ["FLOAT", "volume per km2 of cell"],
    "avg_footprint_m2": ["FLOAT", "mean footprint area, m2"],
}
# Pyramid columns carried from the source, in output order.
PYRAMID_COLUMNS = ("source", "id", "height", "var", "region", "geometry")
# What the pyramid's columns hold, for its metadata.
PYRAMID_COLUMN_TEXTS = {
    "zoomlevel": "zoom at which the row first appears",
    "quadkey": "quadkey of the centroid at the largest zoom",
    "source": "data source of the building",
    "id": "identifier in the source",
    "height": "height in metres, -999 where unknown",
    "var": "variance of the height",
    "region": "region name",
    "geometry": "footprint polygon, WKB, longitude and latitude in degrees",
}
# Coordinate reference system of all geometry columns.
CRS = "EPSG:4326"
CRS_PROJJSON = {
    "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "WGS 84",
    "datum": {
        "type": "GeodeticReferenceFrame",
        "name": "World Geodetic System 1984",
        "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563},
    },
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [
            {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
        ],
    },
    "id": {"authority": "EPSG", "code": 4326},
}
