"""Map projection and planar distances as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0


def mercator_x(lon: Column) -> Column:
    """Easting in metres, EPSG:3857."""
    return F.radians(lon) * EARTH_RADIUS_M


def mercator_y(lat: Column) -> Column:
    """Northing in metres, EPSG:3857; distances keep the projection's stretch."""
    return F.ln(F.tan(F.radians(lat) / 2.0 + math.pi / 4)) * EARTH_RADIUS_M


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    """Distance from a point to a segment; a segment of length 0 is a point."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = ((px - x1) * dx + (py - y1) * dy) / F.nullif(length2, F.lit(0.0))
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)), F.lit(0.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)
