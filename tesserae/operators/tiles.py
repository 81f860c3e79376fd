"""Spatial tiles: matching barcodes, stitching tiles into one coordinate system, puck geometry."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.matching import primer_overlap

# Homopolymers that mark a barcode as low-complexity.
HOMOPOLYMERS = ("TTTTTT", "AAAAAAAA", "CCCCCCCC", "GGGGGGGG")


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in a stated order (a file's record number)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")


def with_coordinates(cells: DataFrame, barcodes: DataFrame, key: str = "cell_bc") -> DataFrame:
    """Cells that have a position (inner join); others go."""
    return cells.join(barcodes, key)


def tile_matches(tiles: DataFrame, query: DataFrame, tile: str = "puck_id", key: str = "cell_bc", by: str = "cell_bc", threshold: float = 0.1, x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """Per tile: n_barcodes, n_matching (distinct), matching_ratio, extents, and pass_threshold (ratio above it).

    Both sides are made distinct before they meet, so a barcode seen in a billion reads moves once.
    """
    own = tiles.groupBy(F.col(tile).alias("tile"), F.col(key).alias("bc")).agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    seen = query.select(F.col(by).alias("bc")).distinct().withColumn("hit", F.lit(1))
    met = own.join(seen, "bc", "left").groupBy("tile")
    out = met.agg(F.count("*").alias("n_barcodes"), F.count("hit").alias("n_matching"), F.min("x0").alias("x_pos_min_px"), F.max("x1").alias("x_pos_max_px"), F.min("y0").alias("y_pos_min_px"), F.max("y1").alias("y_pos_max_px"))
    ratio = F.col("n_matching") / F.col("n_barcodes")
    return out.withColumn("matching_ratio", ratio).withColumn("pass_threshold", ratio > threshold)


def matched_rows(tiles: DataFrame, query: DataFrame, key: str = "cell_bc", by: str = "cell_bc") -> DataFrame:
    """Tile rows whose barcode was seen."""
    return tiles.join(query.select(F.col(by).alias("_bc")), F.col(key) == F.col("_bc"), "left_semi")


def tile_summary(matches: DataFrame) -> DataFrame:
    """Extents of a collection of tiles, means of the rest."""
    low, high = ("x_pos_min_px", "y_pos_min_px"), ("x_pos_max_px", "y_pos_max_px")
    rest = ("n_barcodes", "n_matching", "matching_ratio")
    return matches.agg(*[F.min(c).alias(c) for c in low], *[F.max(c).alias(c) for c in high], *[F.avg(c).alias(c) for c in rest])


def stitched(spots: DataFrame, coordinates: DataFrame, puck: str = "puck_id", x: str = "x_pos", y: str = "y_pos", name: str = "cell_bc", rename: bool = True, transform: bool = True) -> DataFrame:
    """Spots of all tiles in one system: offsets of (puck_id, x_offset, y_offset) added, names made unique as name:puck."""
    to = coordinates.select(F.col(puck).alias("_puck"), "x_offset", "y_offset")
    out = spots.join(to, F.col(puck) == F.col("_puck")).drop("_puck")
    if transform:
        out = out.withColumns({x: F.col(x) + F.col("x_offset"), y: F.col(y) + F.col("y_offset")})
    if rename:
        out = out.withColumn(name, F.concat_ws(":", name, F.col(puck).cast("string")))
    return out.drop("x_offset", "y_offset")


def joined_counts(tiles: list[DataFrame], how: str = "outer") -> DataFrame:
    """Union of long count tables; inner keeps genes that every tile has."""
    out = None
    for i, t in enumerate(tiles):
        own = t.withColumn("_tile", F.lit(i))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if how == "inner":
        common = out.groupBy("gene").agg(F.countDistinct("_tile").alias("n")).filter(F.col("n") == len(tiles))
        out = out.join(common.select("gene"), "gene", "left_semi")
    return out.drop("_tile")


def one_value(df: DataFrame, column: str) -> bool:
    """Whether all rows share one value of the column."""
    return df.agg(F.countDistinct(column)).first()[0] == 1


def coordinate_system(spark, lanes: int, columns: int, rows: int, x_offset: int, y_offset: int, swath_odd: int, swath_even: int, zero_coded: bool = False, extra_column: bool = False, name: str = "L{lane}{side_letter}_tile_{side_number}{column:0>2}{row:0>2}") -> DataFrame:
    """(puck_id, x_offset, y_offset, z_offset) of a flow cell's tiles: lanes x 2 sides x columns x rows.

    Numbers start at 1, or 0 if zero_coded. extra_column also makes column 0 of a one-coded system. Sides alternate the
    sign of the swath offset, columns its size.
    """
    first = 0 if zero_coded else 1
    lane = spark.range(first, first + lanes).select(F.col("id").alias("lane"))
    side = spark.range(1, 3).select(F.col("id").alias("side"))
    column = spark.range(0 if extra_column else first, columns + first).select(F.col("id").alias("column"))
    row = spark.range(first, first + rows).select(F.col("id").alias("row"))
    grid = lane.crossJoin(side).crossJoin(column).crossJoin(row)  # an outer product of four short ranges is what is asked for
    swath = F.when(F.col("column") % 2 == 1, F.lit(swath_odd)).otherwise(F.lit(swath_even)) * F.when(F.col("side") == 1, -1).otherwise(1)
    letter = F.when(F.col("side") == 1, "a").otherwise("b")
    parts = {"{lane}": F.col("lane").cast("string"), "{side_letter}": letter, "{side_number}": F.col("side").cast("string"), "{column:0>2}": F.lpad(F.col("column").cast("string"), 2, "0"), "{row:0>2}": F.lpad(F.col("row").cast("string"), 2, "0"), "{column}": F.col("column").cast("string"), "{row}": F.col("row").cast("string")}
    puck = F.lit(name)
    for k, v in parts.items():
        puck = F.replace(puck, F.lit(k), v)
    return grid.select(puck.alias("puck_id"), (F.col("column") * x_offset).alias("x_offset"), (F.col("row") * y_offset + swath).alias("y_offset"), F.lit(0).cast("long").alias("z_offset"))


def puck_geometry(spots: DataFrame, width_um: float, x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """One row: extents, coord_by_um, width_um and height_um (cut to an integer); a puck without width has 1 and 1."""
    e = spots.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    by = F.when(wide > 0, wide / width_um).otherwise(1.0)
    height = F.when(wide > 0, F.floor(high / (wide / width_um))).otherwise(1)
    return e.select("x0", "x1", "y0", "y1", by.cast("double").alias("coord_by_um"), F.lit(float(width_um)).alias("width_um"), height.cast("long").alias("height_um"))


def known_barcodes(detected: DataFrame, known: DataFrame, key: str = "cell_bc", by: str = "cell_bc") -> DataFrame:
    """One row: distinct detected barcodes, how many are known, and how many are known when reversed (a control)."""
    own = detected.select(F.col(key).alias("bc")).distinct()
    listed = known.select(F.col(by).alias("bc")).distinct().withColumn("hit", F.lit(1))
    n = own.join(listed, "bc", "left").agg(F.count("*").alias("n_detected"), F.count("hit").alias("n_known"))
    back = own.select(F.reverse("bc").alias("bc")).join(listed, "bc", "left_semi").agg(F.count("*").alias("n_reversed"))
    both = n.unionByName(back, allowMissingColumns=True)  # two single rows become one
    return both.agg(*[F.max(c).alias(c) for c in ("n_detected", "n_known", "n_reversed")])


#: Smallest bead of a map by the number of spots from which on it holds (fixed values).
BEADS = ((25_000, 0.05), (10_000, 0.1), (5_000, 0.5), (-1, 0.75))


def map_scales(spots: DataFrame, px_by_um: float = 1.0, spot_diameter_um: float = 1.0, mesh_diameter_um: float | None = None, x: str = "x_pos", y: str = "y_pos") -> dict:
    """What a map of spots needs: marks on both axes with their labels in mm, and the size of a bead. Extents alone reach the driver.

    Marks stand a third of the width apart, in tenths of a millimetre where it is under 3 mm, else in whole ones; at least one such unit.
    """
    e = spots.agg(F.count("*").alias("n"), F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if not e["n"]:
        return {"x": [], "y": [], "x_labels": [], "y_labels": [], "bead": BEADS[-1][1], "px_by_um": px_by_um}
    width = (e["x1"] - e["x0"]) / px_by_um
    digits = 2 if width < 3000 else 3
    apart = max(10.0**digits, round(width / 3, digits))
    out: dict = {"px_by_um": px_by_um}
    for axis in "xy":
        low, high = e[f"{axis}0"], e[f"{axis}1"]
        marks = range(math.ceil((high - low) / (apart * px_by_um)))
        out[axis] = [low + i * apart * px_by_um for i in marks]
        out[f"{axis}_labels"] = [f"{round(i * apart / 1000, 1)} mm" for i in marks]
    least = next(size for above, size in BEADS if e["n"] > above)
    return out | {"bead": max(least, spot_diameter_um if mesh_diameter_um is None else mesh_diameter_um)}


def image_coordinates(spots: DataFrame, scale: float, x0: float = 0.0, y0: float = 0.0, x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """Spots in pixels of an image: moved to its corner and scaled."""
    return spots.withColumns({x: (F.col(x) - x0) * scale, y: (F.col(y) - y0) * scale})


def clean_barcodes(df: DataFrame, primer: str, column: str = "cell_bc") -> DataFrame:
    """Drop low-complexity barcodes and those that look like the primer.

    The longest substring shared with the reversed primer disqualifies if longer than 3 at the barcode's end, or longer
    than 6 anywhere; so does a homopolymer. The placeholder tag XC goes too.
    """
    overlap = primer_overlap(F.col(column), primer[::-1])
    like = ((overlap["length"] > 3) & (overlap["end"] == F.length(column))) | (overlap["length"] > 6)
    poor = F.lit(False)
    for h in HOMOPOLYMERS:
        poor = poor | F.col(column).contains(h)
    return df.filter((F.col(column) != "TAG=XC") & ~like & ~poor)
