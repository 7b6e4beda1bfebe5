"""The pipeline against a plain version of its stages, and the queries' SQL."""

import collections
import pathlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import common, queries
from tests.conftest import SF, rows
from tests.llm import helpers
from tests.llm.test_joins import classes_of, earlier_lines, fewest_edits, shingle_set
from tests.llm.test_quality import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    steps = {}
    for name, f in corpus_pipeline.STAGES:
        docs = common.stage(f(spark, docs, SF), "test")
        steps[name] = docs
    kept = {n: {r.doc_id: r for r in d.collect()} for n, d in list(steps.items())[:4]}
    for name, d in list(steps.items())[:4]:
        assert d.columns == columns, name

    after = kept["quality rules"]
    for i, t in texts.items():
        b = brute(t)
        if b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]:
            assert i not in after
    assert len(after) > 0.7 * len(texts)

    gone = collections.defaultdict(set)
    for i, n, _ in earlier_lines([(i, r.text) for i, r in after.items()], 2):
        gone[i].add(n)
    want = {i: "\n".join(x for n, x in enumerate(r.text.split("\n")) if n not in gone[i]) for i, r in after.items()}
    want = {i: t for i, t in want.items() if re.search(r"[^\x20\x09-\x0D]", t) or not gone[i]}
    assert {i: r.text for i, r in kept["line dedup"].items()} == want
    assert all(r.n_chars == len(r.text) for i, r in kept["line dedup"].items() if gone[i])

    ids = sorted(want)
    sets = [shingle_set(want[i], 5) for i in ids]
    links = [(i, j) for i in range(len(ids)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert set(kept["n-gram Jaccard join"]) == {ids[c] for c in classes_of(len(ids), links)}

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i for i, r in kept["n-gram Jaccard join"].items() if not any(p in r.text for p in items)}
    assert set(kept["benchmark decontamination"]) <= left
    for i in left - set(kept["benchmark decontamination"]):
        t = re.sub(r"[\t-\r]", " ", kept["n-gram Jaccard join"][i].text.lower())
        assert any(fewest_edits(re.sub(r"[\t-\r]", " ", p.lower()), t) <= 0.05 * len(p.encode()) for p in items)

    packed = steps["packing"].toPandas()
    assert set(packed.doc_id) == set(kept["benchmark decontamination"])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, SF).toArrow()
    assert got.num_rows > 0 or name == "op6_decontamination"
    if name in queries.oracle_sql():
        c = duckdb.connect()
        for t in ("documents", "pages"):
            c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        assert rows(got) == rows(c.execute(queries.oracle_sql()[name]).to_arrow_table())


def test_stages_on_awkward_rows(spark, tmp_path):
    """Null ids, texts and languages, empty and long texts, repeated rows, and columns with clashing names."""
    docs = helpers.awkward(spark).withColumn("n_words", F.lit("clash")).withColumn("__near", F.lit(1)).withColumn("component_id", F.lit(2)).withColumn("block", F.lit(3))
    helpers.labels(spark, [(1, 1, 0), (None, 0, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage here, none at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, f in corpus_pipeline.STAGES[:4]:
        out = f(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert f(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        left = {r.doc_id for r in out.collect()}
        assert left <= {r.doc_id for r in docs.collect()} and (name == "quality rules" or None in left), name
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_workspace_leaves_nothing(spark):
    folder = pathlib.Path(common.prepare(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with common.workspace(spark):
        assert queries.op7_url_filters(spark, SF).count() > 0
        assert set(folder.iterdir()) > before
    assert set(folder.iterdir()) == before and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == was


def test_shared_folder_is_asked_for_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = type("Conf", (), {"set": staticmethod(lambda k, v: None), "get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.prepare(Session)
