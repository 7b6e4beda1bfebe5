"""A fluent facade over a run's tables: every method returns a new dataset, and nothing runs before a table is written."""

from __future__ import annotations

from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import barcodes as bc
from tessera.operators import images as im
from tessera.operators import fourier, joins, kernels, registration, stitch
from tessera.sources import sinks


@dataclass(frozen=True)
class Dataset:
    """images: fov, round, channel, z, y, x, v (a single z for flat images); spots, calls, reads and codebook as they are made."""

    images: DataFrame
    height: int
    width: int
    spots: DataFrame | None = None
    calls: DataFrame | None = None
    codebook: DataFrame | None = None
    reads: DataFrame | None = None
    scores: DataFrame | None = None

    KEYS = ("fov", "round", "channel", "z")

    def enhance(self) -> Dataset:
        """Each channel stretched to 0 to 255."""
        keys = list(self.KEYS[:3])
        b = self.images.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        v = self.images.join(b, keys)
        return replace(self, images=v.select(*self.KEYS, "y", "x", F.round(im.stretch(v, keys, "v", F.col("lo"), F.col("hi"))).cast("long").alias("v")))

    def tophat(self, radius: int = 3) -> Dataset:
        t = im.top_hat(self.images, list(self.KEYS), "v", radius, self.height, self.width)
        return replace(self, images=t.select(*self.KEYS, "y", "x", F.col("tophat").alias("v")))

    def project(self, how: str = "max") -> Dataset:
        """Each channel's largest values over its planes, or their sums."""
        keys = list(self.KEYS[:3])
        p = self.images.groupBy(*keys, "y", "x").agg({"max": F.max, "sum": F.sum}[how]("v").alias("v"))
        return replace(self, images=p.withColumn("z", F.lit(0).cast("long")).select(*self.KEYS, "y", "x", "v"))

    @classmethod
    def load(cls, images: DataFrame, roles: dict[str, int] | None = None, quarters: int = 0, flip: bool = False, zrange: tuple[int, int] | None = None) -> Dataset:
        """A dataset from stacks as read (fov, round, channel, z, y, x, v): channels chosen and numbered by roles, planes of a range, and all of
        a field cut to its images' least depth, height and width, then turned by quarters and mirrored up and down."""
        v = images
        if roles:
            names = F.create_map(*[F.lit(x) for r in roles.items() for x in r])
            v = v.where(F.col("channel").isin(list(roles))).withColumn("channel", F.try_element_at(names, F.col("channel")).cast("long"))
        if zrange:
            v = v.where(F.col("z").between(*zrange)).withColumn("z", F.col("z") - zrange[0])
        size = v.groupBy("fov", "round", "channel").agg(*[(F.max(c) + 1).alias(f"n{c}") for c in "zyx"])
        size = size.groupBy("fov").agg(*[F.min(f"n{c}").alias(f"n{c}") for c in "zyx"])
        v = v.join(size, "fov").where("z < nz and y < ny and x < nx")
        y, x = im.turned(F.lit(quarters % 4), F.col("ny"), F.col("nx"))
        height = F.col("nx") if quarters % 2 else F.col("ny")
        y = height - 1 - y if flip else y
        v = v.select(*cls.KEYS, y.alias("y"), x.alias("x"), "v")
        far = v.agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w")).first()  # two numbers
        return cls(v, far["h"] or 0, far["w"] or 0)

    def shifts(self, ref_round: int, channel: int | None = None, scale: int = 1, strip: int | None = None) -> DataFrame:
        """fov, round, dz, dy, dx: the circular shift that brings each round's volume onto the reference round's, by Fourier transforms of one
        channel, or of the channels' largest values; at 1 / scale of the size, the shift is scaled up again. A field and round is a group, or with
        `strip` so many of its rows or columns are, for volumes beyond a task's memory."""
        v = self.images if channel is None else self.images.where(F.col("channel") == channel)
        block = lambda c: F.floor(F.col(c) / scale).cast("long").alias(c)
        v = v.groupBy("fov", "round", "z", block("y"), block("x")).agg((F.max("v") if channel is None else F.avg("v")).cast("double").alias("v"))
        ref = v.where(F.col("round") == ref_round).drop("round")
        shape = (-(-self.height // scale), -(-self.width // scale))
        if strip:
            depth = (v.agg(F.max("z")).first()[0] or 0) + 1  # one number
            rounds = v.select("fov", "round").distinct()
            fixed = ref.join(rounds, "fov").select("fov", "round", "z", "y", "x", F.col("v").alias("fixed"), F.lit(0.0).alias("moving"))
            both = fixed.unionByName(v.select("fov", "round", "z", "y", "x", F.lit(0.0).alias("fixed"), F.col("v").alias("moving")))
            both = both.groupBy("fov", "round", "z", "y", "x").agg(F.sum("fixed").alias("fixed"), F.sum("moving").alias("moving"))
            known = ref.select("fov").distinct()
            out = fourier.shifts(both.join(known, "fov", "left_semi"), ["fov", "round"], "fixed", "moving", (depth, *shape), strip)
            return out.select("fov", "round", "dz", *[(F.col(c) * scale).alias(c) for c in ("dy", "dx")])

        def run(p: pd.DataFrame) -> pd.DataFrame:
            moving, fixed = p[~p.fixed], p[p.fixed]
            if not len(moving) or not len(fixed):
                return pd.DataFrame({"fov": [], "round": [], "dz": [], "dy": [], "dx": []})
            depth = int(p.z.max()) + 1
            d = kernels.register_volumes(kernels.volume(fixed, (depth, *shape)), kernels.volume(moving, (depth, *shape)))
            return pd.DataFrame({"fov": [p.fov.iloc[0]], "round": [p["round"].iloc[0]], "dz": [d[0]], "dy": [d[1] * scale], "dx": [d[2] * scale]})

        rounds = v.select("fov", "round").distinct()
        both = v.withColumn("fixed", F.lit(False)).unionByName(ref.join(rounds, "fov").withColumn("fixed", F.lit(True)))
        return both.groupBy("fov", "round").applyInPandas(run, "fov long, round long, dz long, dy long, dx long")

    def register(self, shifts: DataFrame) -> Dataset:
        """Images moved by the shift of their field and round (fov, round, dy, dx, and dz if it is there)."""
        dz = F.col("dz") if "dz" in shifts.columns else F.lit(0)
        v = self.images.join(shifts, ["fov", "round"])
        depth = self.images.groupBy("fov").agg((F.max("z") + 1).alias("__nz"))
        moved = v.join(depth, "fov").select("fov", "round", "channel", (F.col("z") + dz).alias("z"), (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x"), "v", "__nz")
        inside = F.col("y").between(0, self.height - 1) & F.col("x").between(0, self.width - 1) & (F.col("z") >= 0) & (F.col("z") < F.col("__nz"))
        return replace(self, images=moved.where(inside).drop("__nz"))

    def local_shifts(self, ref_round: int, channel: int | None = None, **options) -> DataFrame:
        """fov, round, z, y, x, dz, dy, dx: the displacement of each voxel to where its own round has what the reference round has there (see
        registration.local_field for the options)."""
        return registration.local_field(self.images, ref_round, self.height, self.width, channel, **options)

    def register_locally(self, field: DataFrame) -> Dataset:
        """All channels of each round with a field of displacements taken from where it points to."""
        v = registration.warp(self.images, field, self.height, self.width)
        return replace(self, images=v.withColumn("v", F.rint("v").cast("long")))

    def find_spots(self, ref_round: int, threshold: float = 0.2, adaptive: bool = True) -> Dataset:
        """Regional maxima of the reference round's volumes above a share of their channel's largest value, or of 255; a plateau is one
        spot at its centre."""
        ref = self.images.where(F.col("round") == ref_round)
        top = ref.groupBy("fov", "channel").agg((F.max("v") * threshold if adaptive else F.lit(255.0 * threshold)).cast("double").alias("t"))
        m = im.regional_maxima(ref.select("fov", "channel", "z", "y", "x", "v").join(top, ["fov", "channel"]), ["fov", "channel"], "v", "t")
        spot = F.xxhash64("fov", "channel", "z", "y", "x").alias("spot_id")
        return replace(self, spots=m.select(spot, "fov", "channel", "z", "y", "x", "v"))

    def extract(self, dy: int = 2, dx: int = 2, dz: int = 1) -> Dataset:
        """The colour of every spot in every round, from the sums of the channels over so many voxels to each side of it inside the image, and
        all of them as one string; N where a sum isn't a number, M where two are the largest."""
        rounds = self.images.select("round").distinct()
        at = self.spots.select("spot_id", "fov", "z", "y", "x").crossJoin(F.broadcast(rounds))  # a run's rounds
        sums = self._sums(at, dy, dx, dz)
        call = bc.call_color(F.transform(F.array_sort(F.collect_list(F.struct("channel", "s"))), lambda c: c["s"]))
        called = sums.groupBy("spot_id", "fov", "z", "y", "x", "round").agg(call.alias("c"))
        seq = called.groupBy("spot_id", "fov", "z", "y", "x").agg(F.array_sort(F.collect_list(F.struct("round", "c"))).alias("r"))
        text = F.array_join(F.transform("r", lambda r: r["c"]["color"]), "").alias("color_seq")
        return replace(self, calls=seq.select("spot_id", "fov", "z", "y", "x", text, F.transform("r", lambda r: r["c"]["score"]).alias("scores")))

    def _sums(self, at: DataFrame, dy: int, dx: int, dz: int) -> DataFrame:
        box = at
        for axis, reach in (("z", dz), ("y", dy), ("x", dx)):
            box = box.withColumn(f"b{axis}", F.explode(F.sequence(F.col(axis) - reach, F.col(axis) + reach)))
        v = self.images.select("fov", "round", "channel", *[F.col(c).alias(f"b{c}") for c in "zyx"], "v")
        joined = box.join(v, ["fov", "round", "bz", "by", "bx"])
        return joined.groupBy("spot_id", "fov", "z", "y", "x", "round", "channel").agg(F.sum("v").cast("double").alias("s"))

    def load_codebook(self, codebook: DataFrame, reverse: bool = True, split: int | None = None) -> Dataset:
        """gene, barcode to colours; of equal colours the gene of the last name counts."""
        colors = bc.encode_bases(F.reverse("barcode") if reverse else F.col("barcode"))
        book = codebook.select("gene", colors.alias("color_seq"))
        if split:
            book = book.withColumn("color_seq", bc.split_rotate(F.col("color_seq"), split))
        return replace(self, codebook=book.groupBy("color_seq").agg(F.max("gene").alias("gene")))

    def filter_reads(self, end_bases: list[str] | None = None, cuts: list[int] | None = None) -> Dataset:
        """Spots without doubtful colours whose string is a gene's. With the first and last base of barcodes (such as ["CC"]), `scores` has for each
        field how many spots have good colours (total) and the shares of them in the codebook (in_codebook) and with bases that begin and end so
        (form_1, form_2 and so on), and reads in the codebook for each of the right form (per_form_1 ...). With cuts, colours are read in segments
        (see barcodes.segments) and the k-th pair of bases is asked of the k-th segment. Fields without good spots have no scores."""
        good = self.calls.where(~F.col("color_seq").rlike("[NM]"))
        out = replace(self, reads=good.join(self.codebook, "color_seq").select("fov", "x", "y", "z", "gene", "spot_id"))
        if not end_bases:
            return out
        calls = good.groupBy("fov", "color_seq").agg(F.count("*").alias("n"))  # equal colours are decoded once
        colors = bc.segments(F.col("color_seq"), cuts) if cuts else F.array(*[F.col("color_seq")] * len(end_bases))
        rows = calls.join(self.codebook.select("color_seq", F.lit(True).alias("hit")).distinct(), "color_seq", "left")
        rows = rows.withColumn("s", colors)
        number = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
        total, hit = F.sum("n"), number(F.coalesce("hit", F.lit(False)))
        shares = [total.alias("total"), (hit / total).alias("in_codebook")]
        for k, ends in enumerate(end_bases, 1):
            bases = bc.decode_colors(F.get("s", F.lit(k - 1)), ends[0])
            form = number(F.coalesce(bases.startswith(ends[0]) & bases.endswith(ends[1]), F.lit(False)))
            shares.append((form / total).alias(f"form_{k}"))
            if not cuts:
                shares.append(F.try_divide(hit, form).alias(f"per_form_{k}"))
        return replace(out, scores=rows.groupBy("fov").agg(*shares))

    def save_signal(self, path: str, slot: str = "goodSpots", fields: list[str] | str = ("x", "y", "z", "gene")) -> None:
        """The reads (goodSpots) or all spots with their colours (allSpots) as CSV, a folder for each field of view; fields "all" keeps all columns."""
        table = {"goodSpots": self.reads, "allSpots": self.calls if self.calls is not None else self.spots}[slot]
        table = table.select(*[F.concat_ws(";", c).alias(c) if kind.startswith("array") else F.col(c) for c, kind in table.dtypes])
        wanted = None if fields == "all" else [c for c in fields if c in table.columns]
        sinks.write_reads(table, path, wanted, "fov")

    def subtiles(self, pieces: int = 4, ratio: float = 0.1) -> DataFrame:
        """The images cut into pieces by pieces overlapping tiles (see stitch.subtiles): fov, t, round, channel, z, y, x within the tile, v."""
        grid = stitch.subtiles(self.images.sparkSession, self.height, self.width, pieces, ratio)
        rows = grid.select("ind_x", (F.col("scoords_x") - 1).alias("y0"), (F.col("ecoords_x") - 1).alias("y1")).distinct()
        columns = grid.select("ind_y", (F.col("scoords_y") - 1).alias("x0"), (F.col("ecoords_y") - 1).alias("x1")).distinct()
        v = joins.interval_join(self.images, rows, "y", "y0", "y1")
        v = joins.interval_join(v, columns, "x", "x0", "x1")
        t = (F.col("ind_x") * pieces + F.col("ind_y") + 1).alias("t")
        return v.select("fov", t, "round", "channel", "z", (F.col("y") - F.col("y0")).alias("y"), (F.col("x") - F.col("x0")).alias("x"), "v")

    def save_subtiles(self, path: str, pieces: int = 4, ratio: float = 0.1) -> None:
        """The tiles as Parquet, a folder for each field and tile, from which each can be gone on with by itself."""
        self.subtiles(pieces, ratio).repartition("fov", "t").write.partitionBy("fov", "t").mode("overwrite").parquet(path)

    @classmethod
    def load_subtile(cls, spark: SparkSession, path: str, fov: int, t: int) -> Dataset:
        """A saved tile as a dataset of its own; only its folder is read."""
        v = spark.read.parquet(path).where((F.col("fov") == fov) & (F.col("t") == t)).withColumn("fov", F.col("fov").cast("long"))
        return cls.load(v.drop("t"))
