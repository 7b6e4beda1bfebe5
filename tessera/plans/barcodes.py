"""Queries over barcodes, colours and codebook matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import barcodes as bc
from tessera.operators import joins
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

BOOK = f"WITH {fx.CODEBOOK}, {fx.COLORS}"
CALLS = f"WITH {fx.CODEBOOK}, {fx.COLORS}, {fx.READS}, {fx.COLOR_CALLS}"
#: Colours of the pixels in five rounds, from the four channels of each field.
PIXEL_CALLS = f"""WITH {fx.VOXELS}, px AS (
  SELECT fov, y, x, list(v::DOUBLE ORDER BY channel) AS vs FROM voxels GROUP BY fov, y, x HAVING count(*) = 4
), called AS (
  SELECT fov // 5 AS field, fov % 5 AS round, y, x, CASE WHEN len(list_filter(vs, lambda v: v = list_max(vs))) = 1 THEN list_position(vs, list_max(vs))::VARCHAR ELSE 'M' END AS color,
    CASE WHEN len(list_filter(vs, lambda v: v = list_max(vs))) = 1 THEN -ln(list_max(vs) / (sqrt(list_sum(list_transform(vs, lambda v: v * v))) + 1e-6)) ELSE 'inf'::DOUBLE END AS score
  FROM px)"""


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.codebook(spark, sf_dir).withColumn("color_seq", bc.encode_bases(F.reverse("barcode")))


@query(f"{BOOK} SELECT gene, barcode, color_seq FROM colors")
def encode_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes reversed and turned into colours."""
    return book(spark, sf_dir).select("gene", "barcode", "color_seq")


@query(f"""{BOOK}, digits AS (SELECT gene, color_seq, i, color_seq[i]::INT - 1 AS d FROM colors, unnest(range(1, length(color_seq) + 1)) AS u(i)),
acc AS (SELECT gene, color_seq, i, xor(1, bit_xor(d) OVER (PARTITION BY gene ORDER BY i)) AS k FROM digits)
SELECT gene, color_seq, 'C' || string_agg(substr('ACGT', k + 1, 1), '' ORDER BY i) AS bases FROM acc GROUP BY gene, color_seq""")
def decode_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours decoded to bases from a known first base."""
    return book(spark, sf_dir).select("gene", "color_seq", bc.decode_colors(F.col("color_seq"), "C").alias("bases"))


@query(f"{BOOK} SELECT gene, color_seq, substr(color_seq, 4) || substr(color_seq, 1, 2) AS rotated FROM colors")
def split_barcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of barcodes that are read in two parts: the one at the split is lost and the parts change places."""
    return book(spark, sf_dir).select("gene", "color_seq", bc.split_rotate(F.col("color_seq"), 3).alias("rotated"))


@query(f"""{BOOK} SELECT gene, substr(color_seq, 1, 1) AS s1, substr(color_seq, 2) AS s2, substr(color_seq, 3, 1) AS s3, substr(color_seq, 4) AS s4 FROM colors""")
def segment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping segments of the colours at two cuts."""
    s = book(spark, sf_dir).select("gene", bc.segments(F.col("color_seq"), [2, 4]).alias("s"))
    return s.select("gene", *[F.get("s", k).alias(f"s{k + 1}") for k in range(4)])


@query(f"""{CALLS} SELECT fov, count(*) AS total, count(*) FILTER (WHERE contains(color_seq, 'N')) AS no_color,
  count(*) FILTER (WHERE contains(color_seq, 'M')) AS multi_color,
  count(*) FILTER (WHERE NOT contains(color_seq, 'N') AND NOT contains(color_seq, 'M')) AS kept FROM color_calls GROUP BY fov""")
def drop_bad_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads without a missing or doubtful colour, with the numbers of the others."""
    n, m = F.col("color_seq").contains("N"), F.col("color_seq").contains("M")
    return fx.color_calls(spark, sf_dir).groupBy("fov").agg(
        F.count("*").alias("total"), F.count_if(n).alias("no_color"), F.count_if(m).alias("multi_color"), F.count_if(~n & ~m).alias("kept")
    )


@query(f"""{CALLS} SELECT c.gene, count(*) AS n, sum(x)::BIGINT AS sx, sum(y)::BIGINT AS sy FROM color_calls r JOIN colors c ON r.color_seq = c.color_seq GROUP BY c.gene""")
def codebook_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads whose colours are those of a gene, by gene."""
    calls = fx.color_calls(spark, sf_dir).select("x", "y", "color_seq")
    return calls.join(book(spark, sf_dir).select("gene", "color_seq"), "color_seq").groupBy("gene").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))


@query(f"""{CALLS}, good AS (SELECT *, EXISTS (SELECT 1 FROM colors c WHERE c.color_seq = r.color_seq) AS hit,
  list_reduce(list_prepend(1, list_transform(string_split(color_seq, ''), lambda c: c::INT - 1)), lambda a, b: xor(a, b)) = 1 AS form
  FROM color_calls r WHERE NOT contains(color_seq, 'N') AND NOT contains(color_seq, 'M'))
SELECT fov, count(*) AS total, round(count(*) FILTER (WHERE hit) / count(*), 6) AS in_codebook, round(count(*) FILTER (WHERE form) / count(*), 6) AS correct_form,
  round(count(*) FILTER (WHERE hit) / nullif(count(*) FILTER (WHERE form), 0), 6) AS codebook_per_form FROM good GROUP BY fov""")
def filtration_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the reads with good colours that are in the codebook and whose bases begin and end as barcodes do."""
    calls = fx.color_calls(spark, sf_dir).where(~F.col("color_seq").rlike("[NM]"))
    calls = calls.groupBy("fov", "color_seq").agg(F.count("*").alias("n"))  # equal colours are decoded once
    genes = book(spark, sf_dir).select("color_seq", F.lit(True).alias("hit")).distinct()
    bases = bc.decode_colors(F.col("color_seq"), "C")
    form = bases.startswith("C") & bases.endswith("C")
    rows = calls.join(genes, "color_seq", "left").select("fov", "n", F.coalesce("hit", F.lit(False)).alias("hit"), form.alias("form"))
    n, hit, ok = F.sum("n"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("form"), F.col("n")).otherwise(0))
    return rows.groupBy("fov").agg(
        n.alias("total"), F.round(hit / n, 6).alias("in_codebook"), F.round(ok / n, 6).alias("correct_form"),
        F.round(F.try_divide(hit, ok), 6).alias("codebook_per_form"),
    )


def pixel_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = fx.voxels(spark, sf_dir)
    px = v.groupBy("fov", "y", "x").agg(F.array_sort(F.collect_list(F.struct("channel", F.col("v").cast("double").alias("v")))).alias("s")).where(F.size("s") == 4)
    call = bc.call_color(F.transform("s", lambda s: s["v"]))
    return px.select(F.expr("fov div 5").alias("field"), (F.col("fov") % 5).alias("round"), "y", "x", call.alias("c")).select("field", "round", "y", "x", "c.*")


@query(f"{PIXEL_CALLS} SELECT field, round, y, x, color, CASE WHEN isinf(score) THEN NULL ELSE round(score, 6) END AS score FROM called")
def call_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The colour of every pixel in every round and its score (null where no channel is the single largest)."""
    c = pixel_calls(spark, sf_dir)
    return c.withColumn("score", F.when(F.col("color") != "M", F.round("score", 6)))


@query(f"{PIXEL_CALLS} SELECT field, y, x, string_agg(color, '' ORDER BY round) AS color_seq FROM called GROUP BY field, y, x")
def color_seq_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The colours of a place in all rounds, in the rounds' order."""
    s = pixel_calls(spark, sf_dir).groupBy("field", "y", "x").agg(F.array_sort(F.collect_list(F.struct("round", "color"))).alias("s"))
    return s.select("field", "y", "x", F.array_join(F.transform("s", lambda s: s["color"]), "").alias("color_seq"))


@query(f"""WITH {fx.VOXELS}, spots AS (SELECT img, y, x FROM voxels WHERE y % 3 = 1 AND x % 3 = 1)
SELECT s.img, s.y, s.x, sum(v.v)::BIGINT AS v_sum FROM spots s JOIN voxels v ON v.img = s.img AND abs(v.y - s.y) <= 2 AND abs(v.x - s.x) <= 1 GROUP BY ALL""")
def voxel_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sum of the values in a box around each spot, cut at the image's edge."""
    v = fx.voxels(spark, sf_dir).select("img", "y", "x", "v")
    return joins.box_sum(v.where("y % 3 = 1 and x % 3 = 1").select("img", "y", "x"), v, ["img"], {"y": 2, "x": 1}, "v")


@query("""SELECT 'Position' || lpad((l_suppkey % 25 + 1)::VARCHAR, 3, '0') AS fov_id, l_suppkey % 25 + 1 AS fov, count(*) AS n FROM lineitem GROUP BY ALL""")
def fov_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the fields of view and the numbers read back from them."""
    n = fx.table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 25 + 1).alias("k")).agg(F.count("*").alias("n"))
    return n.select(bc.fov_name(F.col("k")).alias("fov_id"), bc.fov_number(bc.fov_name(F.col("k"))).cast("long").alias("fov"), "n")


@query("""SELECT p_brand AS name, row_number() OVER (ORDER BY regexp_extract(p_brand, '\\d+')::INT) AS place FROM (SELECT DISTINCT p_brand FROM part)""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the order of people. The distinct names are few; the window sees those only."""
    names = fx.table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    return names.withColumn("place", F.row_number().over(Window.orderBy(bc.natural_key(F.col("name")), "name")).cast("long"))
