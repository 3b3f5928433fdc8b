"""Regridding and neighbourhood operators.

A cell sends a copy of itself to each target it takes part in and the targets
aggregate what arrives.  The field is first placed by horizontal slice (variable,
level, time), whose size is bounded by the grid; the copies are made and added up
inside that placement, so the raw field crosses the network once and the copies
never do.  Where the work touches few cells, those are picked out first instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.schema import Grid, key_join, series_of
from isopleth.session import materialise
from isopleth.sources.tables import literal_table

EARTH_RADIUS = 6.371e6
#: Up to this many targets an axis' taps carry a broadcast hint; longer ones are left to the optimiser.
BROADCAST_AXIS = 20_000


def _axis_taps(df: DataFrame, name: str, targets: Sequence[float], x0: float, dx: float, n: int, cyclic: bool) -> DataFrame:
    """For each target coordinate its two source indices and weights, as a small table.

    Two rows a target; a table of up to ``2 * BROADCAST_AXIS`` rows is marked for broadcast.
    """
    rows = []
    for t in targets:
        pos = (t - x0) / dx
        if cyclic:
            pos %= n
        elif pos < -1e-9 or pos > n - 1 + 1e-9:
            continue
        k = min(int(pos), n - 1 if cyclic else max(n - 2, 0))
        f = pos - k
        rows.append((k % n, float(t), 1.0 - f))
        rows.append(((k + 1) % n, float(t), f))
    taps = literal_table(df.sparkSession, rows, f"{name}_index int, {name}_target double, {name}_weight double")
    return F.broadcast(taps) if len(targets) <= BROADCAST_AXIS else taps


def regrid_bilinear(
    df: DataFrame,
    grid: Grid,
    target_lats: Sequence[float],
    target_lons: Sequence[float],
    slice_keys: Sequence[str] | None = None,
    place_first: bool | None = None,
) -> DataFrame:
    """Bilinear interpolation to the grid spanned by two target axes, by default of each series and time.

    On a cyclic grid the gap between the last and the first longitude is
    interpolated too.  Targets outside the latitudes, or with a missing corner, are
    NULL and therefore absent.

    A coarse target uses few of the cells: the taps then thin out the field before
    anything is shuffled.  A fine target multiplies the rows, so the field is placed
    by slice first and the copies stay where they are made.  That is a physical choice, by the sizes of the
    two grids alone; ``place_first`` sets it, and the result is the same.
    """
    slice_keys = [*series_of(df), "time"] if slice_keys is None else slice_keys
    lon_taps = _axis_taps(df, "lon", target_lons, grid.lon0, grid.dlon, grid.nlon, grid.cyclic)
    lat_taps = _axis_taps(df, "lat", target_lats, grid.lat0, grid.dlat, grid.nlat, False)
    placed = df.select(*slice_keys, grid.i().alias("lon_index"), grid.j().alias("lat_index"), "value")
    if place_first is None:
        place_first = 4 * len(target_lats) * len(target_lons) > grid.nlat * grid.nlon
    if place_first:
        placed = placed.repartition(*slice_keys)
    return (
        placed.join(lon_taps, "lon_index")
        .join(lat_taps, "lat_index")
        .groupBy(*slice_keys, F.col("lat_target").alias("lat"), F.col("lon_target").alias("lon"))
        .agg(
            F.sum(F.col("lat_weight") * F.col("lon_weight") * F.col("value")).alias("value"),
            F.count("value").alias("corners"),
        )
        .where(F.col("corners") == 4)
        .drop("corners")
    )


def cell_corners(df: DataFrame, grid: Grid, slice_keys: Sequence[str]) -> DataFrame:
    """Corner table of a field: for each cell with all four corners their values, named by the lower left index.

    Columns: slice keys, i, j and v00, v10, v01, v11 (first digit: one column east, second: one row up).
    The field is placed once by slice; every value goes to the four cells that it is a corner of
    within that placement.  On a cyclic grid the cells of the seam reach around.
    """
    placed = df.where(F.col("value").isNotNull()).select(*slice_keys, grid.i().alias("i"), grid.j().alias("j"), "value")
    placed = placed.repartition(*slice_keys) if slice_keys else placed
    names = [(di, dj, f"v{di}{dj}") for dj in (0, 1) for di in (0, 1)]
    corners = F.array(
        *[F.struct(_shift(F.col("i"), -di, grid.nlon, grid.cyclic).alias("i"), (F.col("j") - dj).alias("j"), F.lit(n).alias("n")) for di, dj, n in names]
    )
    sent = placed.select(*slice_keys, "value", F.explode(corners).alias("c")).select(*slice_keys, "value", "c.i", "c.j", "c.n")
    cells = sent.groupBy(*slice_keys, "i", "j").agg(*[F.max(F.when(F.col("n") == n, F.col("value"))).alias(n) for *_, n in names])
    return cells.where(" and ".join(f"{n} is not null" for *_, n in names))


def interpolate_at_points(
    df: DataFrame, grid: Grid, points: DataFrame, point: str, slice_keys: Sequence[str] | None = None
) -> DataFrame:
    """Bilinear interpolation at scattered points (``point``, lat, lon), with the rules of ``regrid_bilinear``.

    Slices are by default those of series and time.  Each point names its cell by arithmetic and
    meets the corner table in one equi-join, after which the value is a sum of four products:
    nothing is grouped or shuffled behind the join, and the optimiser broadcasts the points when they are few.
    """
    slice_keys = [*series_of(df), "time"] if slice_keys is None else list(slice_keys)
    x = (F.col("lon") - grid.lon0) / grid.dlon
    x = F.pmod(x, F.lit(float(grid.nlon))) if grid.cyclic else x
    y = (F.col("lat") - grid.lat0) / grid.dlat
    last_x = grid.nlon - 1 if grid.cyclic else grid.nlon - 2
    placed = (
        points.select(point, "lat", "lon", x.alias("x"), y.alias("y"))
        .where(F.col("y").between(0.0, grid.nlat - 1.0) & F.col("x").between(0.0, float(grid.nlon if grid.cyclic else grid.nlon - 1)))
        .withColumns(
            {
                "i": F.least(F.floor("x"), F.lit(last_x)).cast("int"),
                "j": F.least(F.floor("y"), F.lit(grid.nlat - 2)).cast("int"),
            }
        )
        .select(point, "lat", "lon", "i", "j", (F.col("x") - F.col("i")).alias("fx"), (F.col("y") - F.col("j")).alias("fy"))
    )
    wx, wy = (1.0 - F.col("fx"), F.col("fx")), (1.0 - F.col("fy"), F.col("fy"))
    value = sum((wx[di] * wy[dj] * F.col(f"v{di}{dj}") for dj in (0, 1) for di in (0, 1)), F.lit(0.0))
    return cell_corners(df, grid, slice_keys).join(placed, ["i", "j"]).select(*slice_keys, point, "lat", "lon", value.alias("value"))


def _shift(index: Column, by: Column | int, n: int, cyclic: bool) -> Column:
    moved = index + by
    return F.pmod(moved, F.lit(n)) if cyclic else moved


def despike(
    df: DataFrame,
    grid: Grid,
    slice_keys: Sequence[str] | None = None,
    threshold: float = 150.0,
    ratio: float = 4.0,
    radius: int = 2,
) -> DataFrame:
    """Replace an isolated spike by the median of its (2*radius+1)^2 neighbourhood.

    A value is a spike iff it exceeds ``threshold`` and ``ratio`` times the median;
    neighbours outside the domain are left out.  ``corrected`` marks the changes.

    Only the rare values above the threshold look up their neighbours.  Look-ups and
    corrections are stored as they arise, so the field itself is neither copied nor,
    while they are small enough to broadcast, shuffled.
    """
    slice_keys = [*series_of(df), "date"] if slice_keys is None else slice_keys
    width = F.sequence(F.lit(-radius), F.lit(radius))
    keys = [*slice_keys, "i", "j"]
    field = df.withColumns({"i": grid.i(), "j": grid.j()})
    lookups = (
        field.where(F.col("value") > threshold)
        .select(*slice_keys, F.col("i").alias("ci"), F.col("j").alias("cj"), F.col("value").alias("own"), F.explode(width).alias("di"))
        .select("*", F.explode(width).alias("dj"))
        .select(
            *slice_keys,
            "ci",
            "cj",
            "own",
            _shift(F.col("ci"), F.col("di"), grid.nlon, grid.cyclic).alias("i"),
            (F.col("cj") + F.col("dj")).alias("j"),
        )
    )
    corrections = (
        key_join(field.select(*keys, "value"), materialise(lookups, "look-ups"), keys, "inner")
        .groupBy(*slice_keys, "ci", "cj", "own")
        .agg(F.median("value").alias("median"))
        .where(F.col("own") > ratio * F.col("median"))
        .select(*slice_keys, F.col("ci").alias("i"), F.col("cj").alias("j"), "median")
    )
    return key_join(field, materialise(corrections, "corrections"), keys, "left").select(
        *slice_keys,
        "lat",
        "lon",
        F.coalesce("median", "value").alias("value"),
        F.col("median").isNotNull().alias("corrected"),
    )


def divergence_vorticity(df: DataFrame, grid: Grid, slice_keys: Sequence[str] | None = None) -> DataFrame:
    """Divergence and relative vorticity of (u, v) on the sphere by centred differences.

    div = (du/dx + d(v cos)/dy) / cos and vort = (dv/dx - d(u cos)/dy) / cos, with dx, dy
    in radians times the earth radius.  Cells without all four neighbours (the latitude
    edges, or a missing cell) give NULL.
    """
    slice_keys = [*series_of(df), "time"] if slice_keys is None else slice_keys
    cos = F.cos(F.radians("lat"))
    dx = F.lit(2.0 * EARTH_RADIUS) * F.radians(F.lit(float(grid.dlon)))
    dy = F.lit(2.0 * EARTH_RADIUS) * F.radians(F.lit(float(grid.dlat)))
    here = F.struct(F.lit(0).alias("di"), F.lit(0).alias("dj"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))

    def to(di: int, dj: int, sx: float, sy: float) -> Column:
        return F.struct(F.lit(di).alias("di"), F.lit(dj).alias("dj"), F.lit(sx).alias("sx"), F.lit(sy).alias("sy"))

    # a cell is the eastern neighbour of the cell to its west, and so on
    moves = F.array(here, to(-1, 0, 1.0, 0.0), to(1, 0, -1.0, 0.0), to(0, -1, 0.0, 1.0), to(0, 1, 0.0, -1.0))
    placed = df.select(
        *slice_keys, "lat", "lon", grid.i().alias("i"), grid.j().alias("j"), "u", "v", cos.alias("c")
    ).repartition(*slice_keys)
    m = F.col("m")
    copies = placed.select("*", F.explode(moves).alias("m")).select(
        *slice_keys,
        _shift(F.col("i"), m["di"], grid.nlon, grid.cyclic).alias("i"),
        (F.col("j") + m["dj"]).alias("j"),
        (m["sx"] * F.col("u") / dx + m["sy"] * F.col("v") * F.col("c") / dy).alias("div_part"),
        (m["sx"] * F.col("v") / dx - m["sy"] * F.col("u") * F.col("c") / dy).alias("vort_part"),
        (m["sx"] * m["sx"] + m["sy"] * m["sy"]).alias("neighbour"),
        *[F.when((m["di"] == 0) & (m["dj"] == 0), F.col(c)).alias(f"own_{c}") for c in ("lat", "lon", "c")],
    )
    full = F.col("n") == 4
    return (
        copies.groupBy(*slice_keys, "i", "j")
        .agg(
            F.sum("div_part").alias("div"),
            F.sum("vort_part").alias("vort"),
            F.sum(F.when(F.col("div_part").isNotNull(), F.col("neighbour"))).cast("int").alias("n"),
            *[F.max(f"own_{c}").alias(c) for c in ("lat", "lon", "c")],
        )
        .where(F.col("lat").isNotNull())
        .select(
            *slice_keys,
            "lat",
            "lon",
            F.when(full, F.col("div") / F.col("c")).alias("divergence"),
            F.when(full, F.col("vort") / F.col("c")).alias("vorticity"),
        )
    )
