"""Queries over the table of cells and genes."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import communities, distributions, sparse
from tessera.operators import expression as ops
from tessera.operators.checkpoints import checkpointed
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

E = f"WITH {fx.READS}, {fx.EXPR}"


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.expr(spark, sf_dir)


@query(f"{E} SELECT seg_label, sum(n)::BIGINT AS total_counts, count(*) AS n_genes, max(n) AS top_count FROM expr GROUP BY seg_label")
def qc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and genes of each cell."""
    return ops.cell_metrics(table(spark, sf_dir), "seg_label", "gene", "n")


@query(f"{E} SELECT gene, sum(n)::BIGINT AS total, count(*) AS cells FROM expr GROUP BY gene ORDER BY total DESC, gene LIMIT 20")
def top_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty genes with the most counts."""
    return table(spark, sf_dir).groupBy("gene").agg(F.sum("n").alias("total"), F.count("*").alias("cells")).orderBy(F.desc("total"), "gene").limit(20)


@query(f"""{E}, c AS (SELECT seg_label FROM expr GROUP BY seg_label HAVING sum(n) >= 10 AND count(*) >= 5), g AS (SELECT gene FROM expr GROUP BY gene HAVING count(*) >= 3)
SELECT seg_label, gene, n FROM expr WHERE seg_label IN (SELECT seg_label FROM c) AND gene IN (SELECT gene FROM g)""")
def filter_cells_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with enough counts and genes, and genes in enough cells."""
    e = table(spark, sf_dir)
    c = e.groupBy("seg_label").agg(F.sum("n").alias("t"), F.count("*").alias("g")).where("t >= 10 and g >= 5").select("seg_label")
    g = e.groupBy("gene").agg(F.count("*").alias("c")).where("c >= 3").select("gene")
    return e.join(c, "seg_label", "left_semi").join(g, "gene", "left_semi").select("seg_label", "gene", "n")


@query(f"{E}, m AS (SELECT count(DISTINCT seg_label) AS cells FROM expr) SELECT gene, count(*) AS detected FROM expr, m GROUP BY gene, cells HAVING count(*) > 0.5 * cells")
def detected_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes found in more than a share of the cells."""
    e = table(spark, sf_dir)
    m = e.select("seg_label").distinct().agg(F.count("*").alias("cells"))
    return e.groupBy("gene").agg(F.count("*").alias("detected")).join(F.broadcast(m), F.col("detected") > 0.5 * F.col("cells")).select("gene", "detected")  # one row


@query(f"""{E}, t AS (SELECT seg_label, sum(n)::DOUBLE AS total FROM expr GROUP BY seg_label), q AS (SELECT quantile_cont(total, 0.05) AS lo, quantile_cont(total, 0.95) AS hi FROM t)
SELECT seg_label, total FROM t, q WHERE total > lo AND total < hi""")
def percentile_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose counts lie between two percentiles."""
    t = table(spark, sf_dir).groupBy("seg_label").agg(F.sum("n").cast("double").alias("total"))
    q = t.agg(F.percentile("total", 0.05).alias("lo"), F.percentile("total", 0.95).alias("hi"))
    return t.join(F.broadcast(q), (F.col("total") > F.col("lo")) & (F.col("total") < F.col("hi"))).select("seg_label", "total")  # one row


NORM = f"{E}, t AS (SELECT seg_label, sum(n) AS total FROM expr GROUP BY seg_label), norm AS (SELECT seg_label, gene, n, ln(1 + n / total * 10000) AS v FROM expr JOIN t USING (seg_label))"


@query(f"{NORM} SELECT seg_label, gene, round(v, 6) AS v FROM norm")
def normalize_log1p(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised counts on a logarithmic scale."""
    return ops.normalise(table(spark, sf_dir), "seg_label", "n", 10000.0).select("seg_label", "gene", F.round("log_norm", 6).alias("v"))


SCALED = f"""{NORM}, m AS (SELECT count(DISTINCT seg_label) AS k FROM norm), s AS (SELECT gene, sum(v) / k AS mean, sqrt(greatest(sum(v * v) - k * (sum(v) / k) ** 2, 0) / (k - 1)) AS sd FROM norm, m GROUP BY gene, k)"""


@query(f"{SCALED} SELECT gene, round(mean, 6) AS mean, round(sd, 6) AS sd FROM s")
def gene_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of each gene over all cells."""
    return moments(spark, sf_dir)[1].select("gene", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


def moments(spark: SparkSession, sf_dir: str):
    v = ops.normalise(table(spark, sf_dir), "seg_label", "n", 10000.0).select("seg_label", "gene", F.col("log_norm").alias("v"))
    cells = v.select("seg_label").distinct().agg(F.count("*").alias("k"))
    with_k = v.crossJoin(F.broadcast(cells))  # one row
    s = with_k.groupBy("gene", "k").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    mean = F.col("s") / F.col("k")
    return v, s.select("gene", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") - F.col("k") * mean * mean, F.lit(0.0)) / (F.col("k") - 1)).alias("sd"))


@query(f"""{SCALED}, c AS (SELECT DISTINCT seg_label FROM norm) SELECT c.seg_label, s.gene, round((coalesce(n.v, 0) - mean) / nullif(sd, 0), 4) + 0 AS z FROM c CROSS JOIN s LEFT JOIN norm n ON n.seg_label = c.seg_label AND n.gene = s.gene""")
def scale_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell's value of every gene with mean 0 and deviation 1, those without a count too."""
    return scaled(spark, sf_dir).select("seg_label", "gene", (F.round("z", 4) + 0).alias("z"))


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, m = moments(spark, sf_dir)
    genes = m.agg(F.collect_list(F.struct("gene", "mean", "sd")).alias("genes"))  # the panel: one row
    dense = v.select("seg_label").distinct().crossJoin(F.broadcast(genes)).select("seg_label", F.explode("genes").alias("g")).select("seg_label", "g.*")
    z = F.try_divide(F.coalesce("v", F.lit(0.0)) - F.col("mean"), F.when(F.col("sd") != 0, F.col("sd")))
    return dense.join(v, ["seg_label", "gene"], "left").select("seg_label", "gene", z.alias("z"))


TYPED = f"{E}, {fx.CELLS}, typed AS (SELECT cell_type, gene, n FROM expr JOIN cells USING (seg_label)), sizes AS (SELECT cell_type, count(*) AS m FROM cells WHERE seg_label IN (SELECT seg_label FROM expr) GROUP BY ALL)"


@query(f"""{TYPED}, a AS (SELECT cell_type, gene, sum(n) AS s, sum(n * n) AS q FROM typed GROUP BY ALL), b AS (SELECT a.*, m, sum(m) OVER (PARTITION BY gene) - m AS m2, sum(s) OVER (PARTITION BY gene) - s AS s2, sum(q) OVER (PARTITION BY gene) - q AS q2 FROM a JOIN sizes USING (cell_type)),
t AS (SELECT cell_type, gene, round((s / m - s2 / m2) / sqrt((q - s * s / m) / (m - 1) / m + (q2 - s2 * s2 / m2) / (m2 - 1) / m2), 4) AS t FROM b)
SELECT cell_type, gene, t FROM (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY t DESC, gene) AS k FROM t) WHERE k <= 5""")
def marker_ttest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five genes that most set each cell type apart from the rest, by Welch's t."""
    cells = fx.cells(spark, sf_dir).select("seg_label", "cell_type")
    e = table(spark, sf_dir)
    sizes = cells.join(e.select("seg_label").distinct(), "seg_label", "left_semi").groupBy("cell_type").agg(F.count("*").alias("m"))
    a = e.join(cells, "seg_label").groupBy("cell_type", "gene").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q")).join(sizes, "cell_type")
    rest = Window.partitionBy("gene")
    a = a.select("*", *[(F.sum(c).over(rest) - F.col(c)).alias(f"{c}2") for c in ("m", "s", "q")])
    for k in ("", "2"):
        m, s, q = F.col(f"m{k}"), F.col(f"s{k}"), F.col(f"q{k}")
        a = a.withColumn(f"mean{k}", s / m).withColumn(f"var{k}", (q - s * s / m) / (m - 1))
    t = a.select("cell_type", "gene", F.round(ops.welch(a, "mean", "var", "m", "mean2", "var2", "m2"), 4).alias("t"))
    w = Window.partitionBy("cell_type").orderBy(F.desc("t"), "gene")
    return t.withColumn("k", F.row_number().over(w)).where("k <= 5").drop("k")


@query(f"""{E} SELECT seg_label, round(s, 6) AS s_score, round(g2m, 6) AS g2m_score, CASE WHEN s < 0 AND g2m < 0 THEN 'G1' WHEN s >= g2m THEN 'S' ELSE 'G2M' END AS phase FROM (
  SELECT seg_label, (sum(n) FILTER (WHERE gene IN ('Brand#1', 'Brand#2', 'Brand#3')))::DOUBLE / 3 - (sum(n) FILTER (WHERE gene IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14')))::DOUBLE / 4 AS s0,
    coalesce(sum(n) FILTER (WHERE gene IN ('Brand#1', 'Brand#2', 'Brand#3')), 0)::DOUBLE / 3 - coalesce(sum(n) FILTER (WHERE gene IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14')), 0)::DOUBLE / 4 AS s,
    coalesce(sum(n) FILTER (WHERE gene IN ('Brand#4', 'Brand#5', 'Brand#6')), 0)::DOUBLE / 3 - coalesce(sum(n) FILTER (WHERE gene IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14')), 0)::DOUBLE / 4 AS g2m FROM expr GROUP BY seg_label)""")
def cell_cycle_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two gene sets against a control set, and the phase they mean."""
    mean = lambda ks: F.coalesce(F.sum(F.when(F.col("gene").isin([f"Brand#{k}" for k in ks]), F.col("n"))), F.lit(0)).cast("double") / len(ks)
    control = mean(range(11, 15))
    s = table(spark, sf_dir).groupBy("seg_label").agg((mean((1, 2, 3)) - control).alias("s"), (mean((4, 5, 6)) - control).alias("g"))
    phase = F.when((F.col("s") < 0) & (F.col("g") < 0), "G1").when(F.col("s") >= F.col("g"), "S").otherwise("G2M")
    return s.select("seg_label", F.round("s", 6).alias("s_score"), F.round("g", 6).alias("g2m_score"), phase.alias("phase"))


@query("""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS p FROM embeddings), q AS (SELECT * FROM e WHERE vec_id % 100 = 0),
d AS (SELECT q.vec_id AS q, e.vec_id AS b, round(sum((q.v - e.v) ** 2), 6) AS d FROM q JOIN e ON q.p = e.p AND q.vec_id <> e.vec_id GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, b) AS k FROM d) SELECT q, b, d, k FROM k WHERE k <= 10""")
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all vectors to each of a stated set of queries, those whose id is divisible by 100."""
    e = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    return ops.nearest_vectors(e, e.where("vec_id % 100 = 0"), "vec_id", "v", 10)


@query(f"""{E}, {fx.CELLS}, b AS (SELECT seg_label, CASE WHEN x // 410 >= 4 THEN '40+' ELSE ((x // 410) + 1) * 10 || 'um' END AS band FROM cells), m AS (SELECT band, count(*) AS m FROM b GROUP BY band)
SELECT gene, band, round(sum(n) / m, 6) AS mean FROM expr JOIN b USING (seg_label) JOIN m USING (band) GROUP BY gene, band, m""")
def band_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean counts of each gene in bands of distance, over all the band's cells."""
    k = F.expr("x div 410")
    b = fx.cells(spark, sf_dir).select("seg_label", F.when(k >= 4, "40+").otherwise(F.concat(((k + 1) * 10).cast("string"), F.lit("um"))).alias("band"))
    m = b.groupBy("band").agg(F.count("*").alias("m"))
    e = table(spark, sf_dir).join(b, "seg_label").groupBy("gene", "band").agg(F.sum("n").alias("s"))
    return e.join(m, "band").select("gene", "band", F.round(F.col("s") / F.col("m"), 6).alias("mean"))


RANKED = f"""{E}, {fx.CELLS}, g AS (SELECT DISTINCT gene FROM expr), d AS (SELECT g.gene, c.x < 512 AS near, coalesce(e.n, 0) AS n FROM cells c CROSS JOIN g LEFT JOIN expr e ON e.seg_label = c.seg_label AND e.gene = g.gene),
k AS (SELECT gene, near, rank() OVER (PARTITION BY gene ORDER BY n) + (count(*) OVER (PARTITION BY gene, n) - 1) / 2 AS rk FROM d), t AS (SELECT gene, sum(c * c * c - c) AS ties FROM (SELECT gene, n, count(*)::DOUBLE AS c FROM d GROUP BY ALL) GROUP BY gene),
u AS (SELECT gene, sum(rk) FILTER (WHERE near) - count(*) FILTER (WHERE near) * (count(*) FILTER (WHERE near) + 1) / 2 AS u, (count(*) FILTER (WHERE near))::DOUBLE AS n1, (count(*) FILTER (WHERE NOT near))::DOUBLE AS n2 FROM k GROUP BY gene),
z AS (SELECT gene, u, n1, n2, (u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u JOIN t USING (gene))"""


@query(f"{RANKED} SELECT gene, u, n1::BIGINT AS n1, n2::BIGINT AS n2, round(z, 6) AS z, round({ops.upper_tail_sql('z')}, 6) AS p FROM z")
def rank_sum_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank sum statistic of a band's cells against the rest for each gene, over all cells, those without the gene too, and the
    probability of a larger one (normal approximation with ties)."""
    c = fx.cells(spark, sf_dir).select("seg_label", (F.col("x") < 512).alias("near"))
    sizes = c.agg(F.count_if("near").alias("n1"), F.count_if(~F.col("near")).alias("n2")).first()  # two numbers
    r = table(spark, sf_dir).join(c, "seg_label").select("gene", "near", "n")
    out = ops.rank_sum(r, "gene", "n", "near", F.lit(sizes["n1"]), F.lit(sizes["n2"]))
    return out.select("gene", "u", "n1", "n2", F.round("z", 6).alias("z"), F.round(ops.upper_tail(F.col("z")), 6).alias("p"))


BANDS = f"""{E}, {fx.CELLS}, b AS (SELECT seg_label, least(x // 410, 4) AS band FROM cells), m AS (SELECT band, count(*) AS m FROM b GROUP BY band), g AS (SELECT DISTINCT gene FROM expr),
e AS (SELECT gene, band, sum(n) AS s FROM expr JOIN b USING (seg_label) GROUP BY ALL), d AS (SELECT g.gene, m.band, coalesce(e.s, 0) / m.m AS mean FROM g CROSS JOIN m LEFT JOIN e ON e.gene = g.gene AND e.band = m.band)"""


def band_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, band, z: each gene's mean counts by band, of all the band's cells, with mean 0 and deviation 1 over the bands."""
    b = fx.cells(spark, sf_dir).select("seg_label", F.least(F.expr("x div 410"), F.lit(4).cast("long")).alias("band"))
    m = b.groupBy("band").agg(F.count("*").alias("m"))  # five bands
    e = table(spark, sf_dir).join(b, "seg_label").groupBy("gene", "band").agg(F.sum("n").alias("s"))
    mean = F.coalesce("s", F.lit(0)) / F.col("m")
    d = e.select("gene").distinct().crossJoin(F.broadcast(m)).join(e, ["gene", "band"], "left").select("gene", "band", mean.alias("mean"))
    w = Window.partitionBy("gene")
    sd = F.stddev_samp("mean").over(w)
    return d.select("gene", "band", F.try_divide(F.col("mean") - F.avg("mean").over(w), F.when(sd > 0, sd)).alias("z"))


@query(f"{BANDS} SELECT gene, band, round((mean - avg(mean) OVER w) / nullif(stddev_samp(mean) OVER w, 0), 6) + 0 AS z FROM d WINDOW w AS (PARTITION BY gene)")
def band_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of each gene in each band of distance."""
    return band_scores(spark, sf_dir).select("gene", "band", (F.round("z", 6) + 0).alias("z"))


@query()
def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes clustered by their scores over the bands: cluster, and the band, of the first four, in which the cluster's scores sum
    highest (the nearer where there are ties)."""
    wide = band_scores(spark, sf_dir).groupBy("gene").pivot("band", list(range(5))).agg(F.first("z")).na.fill(0.0)
    wide = checkpointed(wide)  # a row for each gene, which every start reads many times
    v = VectorAssembler(inputCols=[str(k) for k in range(5)], outputCol="features").transform(wide)
    best = None
    for seed in range(5):  # of several starts the one of least cost
        model = KMeans(k=6, seed=seed, maxIter=20, featuresCol="features", predictionCol="cluster").fit(v)
        best = model if best is None or model.summary.trainingCost < best.summary.trainingCost else best
    genes = best.transform(v).withColumn("cluster", F.col("cluster").cast("long"))
    top = genes.groupBy("cluster").agg(*[F.sum(str(k)).alias(f"s{k}") for k in range(4)])
    band = F.array_max(F.array(*[F.struct(F.col(f"s{k}").alias("s"), F.lit(-k).alias("k")) for k in range(4)]))["k"]
    return genes.join(top, "cluster").select("gene", "cluster", (-band).cast("long").alias("band"))


@query()
def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten principal components of the cells with counts, from logarithms of normalised counts scaled by gene."""
    panel = [r[0] for r in fx.codebook(spark, sf_dir).select("gene").orderBy("gene").collect()]  # a codebook's genes
    wide = checkpointed(ops.counts_by_cell(fx.reads(spark, sf_dir).where("seg_label > 0"), "seg_label", "gene", panel))  # read some times, made once
    v = ops.scaled_counts(wide, "seg_label", len(panel), 10000.0)
    v = VectorAssembler(inputCols=v.columns[1:], outputCol="features").transform(v).select("seg_label", "features")
    return PCA(k=min(10, len(panel)), inputCol="features", outputCol="pc").fit(v).transform(v).select("seg_label", vector_to_array("pc").alias("pc"))


@query(f"""{NORM}, {fx.CELLS}, typed AS (SELECT cell_type, gene, v FROM norm JOIN cells USING (seg_label)), sizes AS (SELECT cell_type, count(*) AS m FROM cells WHERE seg_label IN (SELECT seg_label FROM expr) GROUP BY ALL),
a AS (SELECT cell_type, gene, sum(v) AS s, sum(v * v) AS q FROM typed GROUP BY ALL), b AS (SELECT a.*, m, (SELECT sum(m) FROM sizes) - m AS m2, sum(s) OVER (PARTITION BY gene) - s AS s2, sum(q) OVER (PARTITION BY gene) - q AS q2 FROM a JOIN sizes USING (cell_type)),
e AS (SELECT cell_type, gene, s / m - s2 / m2 AS gap, (q - s * s / m) / (m - 1) / m AS e1, (q2 - s2 * s2 / m2) / (m2 - 1) / m2 AS e2, m, m2 FROM b)
SELECT cell_type, gene, round(gap / sqrt(e1 + e2), 4) AS t, round((e1 + e2) ** 2 / (e1 * e1 / (m - 1) + e2 * e2 / (m2 - 1)), 3) AS df FROM e""")
def marker_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Welch's t and its degrees of freedom of each gene in each cell type against all other cells, from logarithms of normalised counts."""
    return markers(spark, sf_dir).select("cell_type", "gene", F.round("t", 4).alias("t"), F.round("df", 3).alias("df"))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = ops.normalise(table(spark, sf_dir), "seg_label", "n", 10000.0).select("seg_label", "gene", F.col("log_norm").alias("v"))
    typed = fx.cells(spark, sf_dir).select("seg_label", "cell_type")
    sizes = typed.join(v.select("seg_label").distinct(), "seg_label", "left_semi").groupBy("cell_type").agg(F.count("*").alias("m"))
    sizes = sizes.crossJoin(F.broadcast(sizes.agg(F.sum("m").alias("all"))))  # one row
    a = v.join(typed, "seg_label").groupBy("cell_type", "gene").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).join(sizes, "cell_type")
    gene = Window.partitionBy("gene")
    a = a.select("*", (F.col("all") - F.col("m")).alias("m2"), *[(F.sum(c).over(gene) - F.col(c)).alias(f"{c}2") for c in "sq"])
    error = lambda k: (F.col(f"q{k}") - F.col(f"s{k}") * F.col(f"s{k}") / F.col(f"m{k}")) / (F.col(f"m{k}") - 1) / F.col(f"m{k}")
    a = a.withColumn("e", error("")).withColumn("e2", error("2"))
    both = F.col("e") + F.col("e2")
    t = F.try_divide(F.col("s") / F.col("m") - F.col("s2") / F.col("m2"), F.when(both > 0, F.sqrt(both)))
    df = F.try_divide(both * both, F.col("e") * F.col("e") / (F.col("m") - 1) + F.col("e2") * F.col("e2") / (F.col("m2") - 1))
    return a.select("cell_type", "gene", t.alias("t"), df.alias("df"))


@query()
def marker_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five genes that most set each cell type apart, with the probability of a t as large either way."""
    w = Window.partitionBy("cell_type").orderBy(F.desc("t"), "gene")
    top = markers(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k <= 5")
    return top.select("cell_type", "gene", F.round("t", 4).alias("t"), F.round(2 * distributions.t_tail(F.abs("t"), F.col("df")), 8).alias("p"))


@query()
def cell_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communities of the cells: a graph of the fifteen nearest of every cell's ten components, and moves of modularity on it."""
    near = checkpointed(ops.nearest_of_all(pca(spark, sf_dir), "seg_label", "pc", 15).select("q", "b", F.sqrt("d").alias("d")))
    return communities.communities(communities.neighbour_graph(near), 0.7, max_turns=12).withColumnsRenamed({"node": "seg_label"})


@query(f"""{E} SELECT seg_label, gene, cell_type, n::BIGINT AS n FROM expr JOIN (SELECT c_custkey + 1 AS seg_label, nullif(c_mktsegment, 'BUILDING') AS cell_type FROM customer) USING (seg_label)""")
def stored_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count matrix out of compressed columns, with each cell's type out of codes (none for one that isn't a category)."""
    entries, pointers = sparse.to_columns(table(spark, sf_dir), "seg_label", "gene", "n")
    long = sparse.from_columns(entries, pointers)
    kinds = ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    code = F.coalesce(F.array_position(F.array(*map(F.lit, kinds)), F.col("cell_type")), F.lit(0)).cast("int") - 1
    cells = fx.cells(spark, sf_dir).select(F.col("seg_label").alias("row"), code.alias("code"))
    names = spark.createDataFrame(list(enumerate(kinds)), "code int, name string")
    typed = sparse.categories(cells, "code", names, "cell_type").drop("code")
    return long.join(typed, "row").select(F.col("row").alias("seg_label"), F.col("col").alias("gene"), "cell_type", F.col("value").cast("long").alias("n"))


CYCLE = {"s": ["Brand#11", "Brand#12", "Brand#13"], "g2m": ["Brand#31", "Brand#32", "Brand#33"]}
BINS = 5


@query(f"""{NORM}, panel AS (SELECT gene, ntile({BINS}) OVER (ORDER BY m, gene) AS bin FROM (SELECT gene, sum(v) AS m FROM norm GROUP BY gene)),
sets(name, gene) AS (VALUES {", ".join(f"('{k}', '{g}')" for k, gs in CYCLE.items() for g in gs)}), own AS (SELECT name, gene, bin FROM sets JOIN panel USING (gene)),
control AS (SELECT DISTINCT o.name, p.gene FROM own o JOIN panel p USING (bin) WHERE (o.name, p.gene) NOT IN (SELECT (name, gene) FROM own)),
w AS (SELECT name, gene, 1.0::DOUBLE / count(*) OVER (PARTITION BY name) AS w FROM own UNION ALL SELECT name, gene, -1.0::DOUBLE / count(*) OVER (PARTITION BY name) FROM control),
p AS (SELECT seg_label, round(coalesce(sum(v * w) FILTER (WHERE name = 's'), 0), 6) + 0 AS s, round(coalesce(sum(v * w) FILTER (WHERE name = 'g2m'), 0), 6) + 0 AS g2m FROM norm LEFT JOIN w USING (gene) GROUP BY seg_label)
SELECT seg_label, s AS s_score, g2m AS g2m_score, CASE WHEN s < 0 AND g2m < 0 THEN 'G1' WHEN s >= g2m THEN 'S' ELSE 'G2M' END AS phase FROM p""")
def cell_cycle_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two gene sets, each against genes of like mean values, from logarithms of normalised counts, and the phase they mean."""
    v = ops.normalise(table(spark, sf_dir), "seg_label", "n", 10000.0).select(F.col("seg_label").alias("cell"), "gene", F.col("log_norm").alias("v"))
    sets = spark.createDataFrame([(k, g) for k, gs in CYCLE.items() for g in gs], "name string, gene string")
    s = ops.gene_set_scores(v, v.select("cell").distinct(), sets, BINS)
    one = lambda k: (F.round(F.max(F.when(F.col("name") == k, F.col("score"))), 6) + 0).alias(k)
    wide = s.groupBy("cell").agg(one("s"), one("g2m"))
    phase = F.when((F.col("s") < 0) & (F.col("g2m") < 0), "G1").when(F.col("s") >= F.col("g2m"), "S").otherwise("G2M")
    return wide.select(F.col("cell").alias("seg_label"), F.col("s").alias("s_score"), F.col("g2m").alias("g2m_score"), phase.alias("phase"))
