"""Tiles: their geometry, and stitching of what lies in their overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import joins


def subtiles(spark: SparkSession, rows: int, cols: int, pieces: int, ratio: float) -> DataFrame:
    """A pieces x pieces grid over an image, tiles numbered row by row from 1, each widened by a share of its size on the sides where it
    has a neighbour; coordinates from 1, ends inclusive. Tile size comes from the rows alone."""
    size = rows // pieces
    half = int(size * ratio)
    n = pieces
    grid = spark.range(n * n).select((F.col("id") + 1).alias("t"), F.expr(f"id div {n}").alias("ind_x"), (F.col("id") % n).alias("ind_y"))

    def start(i):
        return F.when(F.col(i) == 0, 1).otherwise(F.col(i) * size - half + 1).cast("long")

    def end(i, limit):
        return F.when(F.col(i) == n - 1, limit).otherwise((F.col(i) + 1) * size + half).cast("long")

    out = grid.select(
        "t", "ind_x", "ind_y", start("ind_x").alias("scoords_x"), start("ind_y").alias("scoords_y"), end("ind_x", rows).alias("ecoords_x"), end("ind_y", cols).alias("ecoords_y"),
        (F.col("ind_x") * size).alias("upperleft_x"), (F.col("ind_y") * size).alias("upperleft_y"),
    )
    return out.withColumn("inputdim_x", F.expr("ecoords_x - scoords_x + 1")).withColumn("inputdim_y", F.expr("ecoords_y - scoords_y + 1"))


def stitch_corners(rows: DataFrame, tiles: DataFrame, keys: list[str], tile: str, xy: tuple[str, str], corner: tuple[str, str]) -> DataFrame:
    """Rows of overlapping tiles, each place once. Tiles come in order: a tile keeps what lies beyond its corner in both axes (the
    first with any rows keeps all), and takes that quadrant from the tiles before it."""
    filled = rows.groupBy(*keys).agg(F.min(tile).alias("__first"))
    own = rows.join(filled, keys).where(
        (F.col(tile) == F.col("__first")) | ((F.col(xy[0]) > F.col(corner[0])) & (F.col(xy[1]) > F.col(corner[1])))
    ).drop("__first")
    # only tiles that hold rows take anything
    taking = rows.select(*keys, tile).distinct().join(tiles.select(tile, *corner), tile)
    return joins.later_corner_anti(own, taking, keys, tile, xy, corner)


def stitch_regions(rows: DataFrame, keys: list[str], tile: str, xy: tuple[str, str], low: int, high: int) -> DataFrame:
    """Rows outside the bounding boxes (of the tiles' rows, clipped to the canvas) of all tiles before their own."""
    x, y = xy
    clip = lambda c: F.least(F.greatest(c, F.lit(low)), F.lit(high))
    boxes = rows.groupBy(*keys, tile).agg(
        clip(F.min(x)).alias("__x0"), clip(F.max(x)).alias("__x1"), clip(F.min(y)).alias("__y0"), clip(F.max(y)).alias("__y1")
    )
    b = boxes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(tile).alias("__t"), "__x0", "__x1", "__y0", "__y1")
    held = (F.col("__t") < F.col(tile)) & F.col(x).between(F.col("__x0"), F.col("__x1")) & F.col(y).between(F.col("__y0"), F.col("__y1"))
    for k in keys:
        held = held & (F.col(k) == F.col(f"__{k}"))
    return rows.join(b, held, "left_anti")


def stitch_edges(cells: DataFrame, keys: list[str], tile: str, xy: tuple[str, str], start: tuple[str, str], height: int) -> DataFrame:
    """Cells of tiles in order: a tile keeps its cells with x > its start and y > its start, and takes from the tiles before it those
    with x beyond its start and y between its start and that plus the tile's height, all bounds exclusive."""
    x, y = F.col(xy[0]), F.col(xy[1])
    first = cells.groupBy(*keys).agg(F.min(tile).alias("__first"))
    own = cells.join(first, keys).where((F.col(tile) == F.col("__first")) | ((x > F.col(start[0])) & (y > F.col(start[1])))).drop("__first")
    t = cells.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(tile).alias("__t"), F.col(start[0]).alias("__sx"), F.col(start[1]).alias("__sy")).distinct()
    taken = (F.col("__t") > F.col(tile)) & (x > F.col("__sx")) & (y > F.col("__sy")) & (y < F.col("__sy") + height)
    for k in keys:
        taken = taken & (F.col(k) == F.col(f"__{k}"))
    return own.join(t, taken, "left_anti")


def neighbours(grid: DataFrame, col: str, row: str, ident: str, x: str, y: str) -> DataFrame:
    """grid with the coordinates of the left, right, upper and lower tiles that exist and aren't blank (id 0)."""
    out = grid
    for name, dc, dr, value in (("left", -1, 0, x), ("right", 1, 0, x), ("up", 0, -1, y), ("down", 0, 1, y)):
        other = grid.where(F.col(ident) != 0).select((F.col(col) - dc).alias(col), (F.col(row) - dr).alias(row), F.col(value).alias(name))
        out = out.join(other, [col, row], "left")
    return out


def midlines(tiles: DataFrame, x: str, y: str, width: int, height: int) -> DataFrame:
    """Start and end of each tile, at the middle of its overlap with a neighbour or at its own edge. The lower end uses the width,
    as tiles are square."""

    def begin(near, own, size):
        return F.coalesce((((F.col(near) + size - F.col(own)) / 2 + 0.5).cast("int") + F.col(own)).cast("long"), F.col(own))

    def finish(near, own, size, edge):
        return F.coalesce(((F.col(own) + size - F.col(near)) / 2 + 0.5 + F.col(near)).cast("int").cast("long"), F.col(own) + edge)

    return tiles.select(
        "*", begin("left", x, width).alias("start_x"), begin("up", y, height).alias("start_y"),
        finish("right", x, width, width).alias("end_x"), finish("down", y, width, height).alias("end_y"),
    )


def stage_grid(stage: DataFrame, keys: list[str], x: str, y: str, order: str) -> DataFrame:
    """Grid places of stage positions: the step is the most frequent difference other than zero between neighbours in order
    (the smaller where there are ties), and places count steps from the least position."""
    w = Window.partitionBy(*keys).orderBy(order)
    moves = stage.withColumn("d", F.abs(F.lead(y).over(w) - F.col(y))).where("d > 0")
    counted = moves.groupBy(*keys, "d").agg(F.count("*").alias("c"))
    step = counted.groupBy(*keys).agg(F.min(F.struct(-F.col("c"), "d"))["d"].alias("step"))
    least = stage.groupBy(*keys).agg(F.min(x).alias("x0"), F.min(y).alias("y0"))
    at = lambda v, v0: ((F.col(v) - F.col(v0)) / F.col("step") + 0.5).cast("int").cast("long")
    return stage.join(step, keys).join(least, keys).select(*stage.columns, "step", at(x, "x0").alias("col"), at(y, "y0").alias("row"))


def dense_grid(sparse: DataFrame, keys: list[str], col: str, row: str, ident: str) -> DataFrame:
    """All places of each grid up to its largest column and row, with the sum of the ids there or 0 where it is blank."""
    size = sparse.groupBy(*keys).agg(F.max(col).alias("__c"), F.max(row).alias("__r"))
    places = size.withColumn(col, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__c")))).withColumn(row, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__r"))))
    ids = sparse.groupBy(*keys, col, row).agg(F.sum(ident).alias("id"))
    name = F.concat_ws("_", F.lit("tile"), F.col(row), F.col(col)).alias("grid")
    return places.join(ids, [*keys, col, row], "left").select(*keys, col, row, F.coalesce("id", F.lit(0).cast("long")).alias("id"), name)
