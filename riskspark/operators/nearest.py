"""Distance to the nearest line or point of a layer, by pruned search in a grid tree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.geo import mercator_x, mercator_y, segment_distance
from riskspark.operators.joins import BROADCAST_ROWS, fits_broadcast
from riskspark.session import materialize, spread_by

c = F.col
FAN = 4  # a crowded cell is cut into FAN x FAN cells
CROWDED = 32
MAX_LEVEL = 12
CELL = ["level", "cx", "cy"]


def project_layer(layer: DataFrame) -> DataFrame:
    """Distinct segments in metres; copies cannot change a distance."""
    ends = [
        mercator_x(c("lon1")).alias("x1"),
        mercator_y(c("lat1")).alias("y1"),
        mercator_x(c("lon2")).alias("x2"),
        mercator_y(c("lat2")).alias("y2"),
    ]
    return layer.select(*ends).dropna().distinct()


def _cell_of_segment(size: Column | float, x0: float, y0: float) -> Column:
    """Whether the segment touches the square cell (separating-axis test)."""
    half = F.lit(size / 2)
    mx = (c("x1") + c("x2")) / 2 - (F.lit(x0) + (c("cx") + 0.5) * size)
    my = (c("y1") + c("y2")) / 2 - (F.lit(y0) + (c("cy") + 0.5) * size)
    dx, dy = (c("x2") - c("x1")) / 2, (c("y2") - c("y1")) / 2
    slack = size * 1e-9
    return (
        (F.abs(mx) <= half + F.abs(dx) + slack)
        & (F.abs(my) <= half + F.abs(dy) + slack)
        & (F.abs(mx * dy - my * dx) <= (F.abs(dx) + F.abs(dy)) * (half + slack))
    )


def _children(cells: DataFrame) -> DataFrame:
    grid = F.array(
        *(
            F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j"))
            for i in range(FAN)
            for j in range(FAN)
        )
    )
    others = [n for n in cells.columns if n not in CELL]
    return cells.select(*CELL, *others, F.inline(grid)).select(
        (c("level") + 1).alias("level"),
        (c("cx") * FAN + c("i")).alias("cx"),
        (c("cy") * FAN + c("j")).alias("cy"),
        *others,
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _grow_tree(segments: DataFrame, x0: float, y0: float, side: float):
    """Split the root, then crowded cells until none is left.

    Returns per level below the root its cells and the number of their
    parents, and the segments per leaf with their number.
    """
    zero = F.lit(0).cast("long")
    pieces = segments.withColumns({"level": F.lit(0), "cx": zero, "cy": zero})
    def split(crowded: DataFrame, level: int) -> DataFrame:
        size = side / FAN ** (level + 1)
        return materialize(
            _children(crowded).where(_cell_of_segment(size, x0, y0)), f"pieces{level}"
        )

    pieces = split(pieces, 0)
    levels, leaves, leaf_rows, parents = [], None, 0, 1
    for level in range(1, MAX_LEVEL + 1):
        counted = pieces.groupBy(*CELL).agg(F.count("*").alias("n"))
        cells = materialize(counted, f"cells{level}")
        crowded_cell = (c("n") > CROWDED) & F.lit(level < MAX_LEVEL)
        crowded, settled = cells.agg(
            F.count_if(crowded_cell), F.coalesce(F.sum(F.when(~crowded_cell, c("n"))), F.lit(0))
        ).first()
        levels.append((cells.select(*CELL), parents))
        leaf_rows += settled
        inner = _small(cells.where(crowded_cell).select(*CELL), crowded)
        done = pieces.join(inner, CELL, "left_anti") if crowded else pieces
        leaves = done if leaves is None else leaves.unionByName(done)
        if not crowded:
            break
        pieces = split(pieces.join(inner, CELL, "left_semi"), level)
        parents = crowded
    return levels, leaves, leaf_rows


def _box_bounds(side: float, x0: float, y0: float) -> tuple[Column, Column]:
    """Least and greatest distance from (px, py) to the points of a cell."""
    size = F.lit(side) / F.pow(F.lit(float(FAN)), c("level"))
    left, low = F.lit(x0) + c("cx") * size, F.lit(y0) + c("cy") * size

    def near(p, a):
        return F.greatest(a - p, F.lit(0.0), p - (a + size))

    def far(p, a):
        return F.greatest(F.abs(p - a), F.abs(p - (a + size)))

    nx, ny, fx, fy = near(c("px"), left), near(c("py"), low), far(c("px"), left), far(c("py"), low)
    return F.sqrt(nx * nx + ny * ny), F.sqrt(fx * fx + fy * fy)


def nearest_distance_km(
    points: DataFrame,
    layer: DataFrame,
    out: str = "distance_to_water_km",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Add the distance in km to the nearest layer feature, one row per point.

    Layer segments sit in the leaves of a grid tree whose crowded cells are
    split further, so dense areas get small cells. The distinct places of the points
    walk down the tree together, one join per level, and keep only cells that can
    still hold the nearest segment. Without a layer or coordinates the distance is 0.
    """
    points = points.drop(out)
    segments = materialize(project_layer(layer), "segments")
    ends = segments.select(
        F.least(F.min("x1"), F.min("x2")), F.least(F.min("y1"), F.min("y2")),
        F.greatest(F.max("x1"), F.max("x2")), F.greatest(F.max("y1"), F.max("y2")),
    ).first()
    if ends[0] is None:
        return points.withColumn(out, F.lit(0.0))
    x0, y0 = ends[0], ends[1]
    side = max(ends[2] - x0, ends[3] - y0, 1.0)
    levels, pieces, n_pieces = _grow_tree(segments, x0, y0, side)

    placed = materialize(
        points.withColumns({"_px": mercator_x(c(lon)), "_py": mercator_y(c(lat))}), "points"
    )
    somewhere = c("_px").isNotNull() & c("_py").isNotNull() & (F.abs("_py") < float("inf"))
    # Points of one place share a walk, so the work goes by places, not by points.
    places = placed.where(somewhere).select(c("_px").alias("px"), c("_py").alias("py")).distinct()
    numbered = places.withColumn("place", F.monotonically_increasing_id())
    spread = spread_by(materialize(numbered, "places"), "place")
    top = F.array(  # the cells below the root, FAN * FAN at most
        *(
            F.struct(*(F.lit(r[n]).cast(t).alias(n) for n, t in zip(CELL, ("int", "long", "long"))))
            for r in levels[0][0].collect()
        )
    )
    near, far = _box_bounds(side, x0, y0)
    best = F.min("far").over(Window.partitionBy("place"))

    def prune(candidates: DataFrame) -> DataFrame:
        reach = candidates.withColumns({"near": near, "far": far}).withColumn("best", best)
        kept = reach.where(c("near") <= c("best") * (1 + 1e-9) + side * 1e-9)
        return kept.select("place", "px", "py", *CELL)

    front = prune(spread.select("place", "px", "py", F.inline(top)))
    for cells, parents in levels[1:]:
        kids = cells.groupBy(
            (c("level") - 1).alias("level"),
            F.floor(c("cx") / FAN).alias("cx"),
            F.floor(c("cy") / FAN).alias("cy"),
        ).agg(F.collect_list(F.struct(*CELL)).alias("kids"))
        itself = F.array(F.struct(*CELL))
        front = prune(
            front.join(_small(kids, parents), CELL, "left").select(
                "place", "px", "py", F.inline(F.coalesce("kids", itself))
            )
        )
    distance = segment_distance(c("px"), c("py"), c("x1"), c("y1"), c("x2"), c("y2"))
    found = (
        front.join(_small(pieces, n_pieces), CELL)
        .groupBy("px", "py")
        .agg((F.min(distance) / 1000.0).alias(out))
    )
    found = materialize(found.withColumnsRenamed({"px": "_px", "py": "_py"}), "distances")
    if fits_broadcast(found):
        found = F.broadcast(found)
    joined = placed.join(found, ["_px", "_py"], "left").withColumn(out, F.coalesce(out, F.lit(0.0)))
    return joined.drop("_px", "_py")
