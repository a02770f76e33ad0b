"""Popular values, hubs and equal rows: split between tasks, and with the results of the SQL."""

import duckdb
import pytest
from helpers import docs
from pyspark.sql import functions as F

from ledgerline.llm import jaccard, orc_tokens, secrets
from ledgerline.llm.frames import scratch, stored
from ledgerline.llm.oracle import ORACLE_SQL


@pytest.fixture
def small_partitions(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def test_a_popular_secret_is_split_between_tasks(spark, small_partitions):
    found = spark.range(40_000).repartition(8).selectExpr(
        "xxhash64(id) AS a", "id AS b", "'s' AS owner", "'en' AS repository", "'hex' AS kind", "0L AS start", "20L AS end",
        "IF(id % 10 > 0, 'abcdef0123456789abcd', sha2(CAST(id AS STRING), 256)) AS value", "0L AS value_start",
    )
    rows = secrets.judged(stored(found, "found")).groupBy().agg(
        F.max("a"), F.max("n_uses").alias("uses"), F.count_if("live").alias("live")
    )
    assert "skew=true" in plan_of(rows)
    assert rows.first()["uses"] == 36_000 and rows.first()["live"] == 40_000


def test_secret_ownership_matches_the_sql_where_owners_and_repositories_differ(spark):
    key = "password = Zx9kQ2mW7pLt4vB8"
    rows = [(1, f"{key}1", "s", "en"), (2, f"{key}1", "s", "de"), (3, f"{key}1", "s", "fr"),
            (4, f"{key}2", "s", "en"), (5, f"{key}3", "s", "en"), (6, f"{key}3", "t", "en"),
            (7, f"{key}4", None, "en"), (8, f"{key}4", "t", None), (9, f"{key}4", None, None),
            (10, f"{key}5", None, None), (10, f"{key}5", None, None), (11, None, "s", "en"), (12, "", "s", "en")]
    frame = spark.createDataFrame(
        [(i, t, lang, source, 1) for i, t, source, lang in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    documents = frame.toArrow()  # noqa: F841
    cursor = duckdb.connect().execute(ORACLE_SQL["op6_secret_ownership"])
    names = [c[0] for c in cursor.description]
    out = secrets.report(frame)
    assert sorted(names) == sorted(out.columns)
    assert sorted(map(str, out.select(*names).collect())) == sorted(
        str(r) for r in spark.createDataFrame(cursor.fetchall(), out.select(*names).schema).collect()
    )
    by_id = {r["doc_id"]: r for r in out.collect()}
    # One owner, three repositories: an example. One of each: live. Two owners: neither.
    assert (by_id[1]["n_owners"], by_id[1]["n_repositories"], by_id[1]["n_live"], by_id[1]["n_example"]) == (1, 3, 0, 1)
    assert (by_id[4]["n_live"], by_id[4]["n_example"]) == (1, 0)
    assert (by_id[5]["n_owners"], by_id[5]["n_live"], by_id[5]["n_example"]) == (2, 0, 0)
    assert (by_id[7]["n_owners"], by_id[7]["n_repositories"], by_id[7]["n_example"]) == (2, 3, 1)
    assert by_id[10]["n_live"] == 1


def test_a_hub_is_split_between_tasks(spark, small_partitions, monkeypatch):
    """Half of all edges lead to one node, whose name is the smallest."""
    edges = spark.range(40_000).repartition(8).selectExpr(
        "IF(id % 2 = 0, 0L, id + 1000000) AS sid", "IF(id % 2 = 0, id + 2000000, id + 3000000) AS other"
    )
    plans = []

    def keep(df, name):
        plans.append(plan_of(df))
        return stored(df, name)

    monkeypatch.setattr(jaccard, "stored", keep)
    roots = jaccard.components(edges)
    assert any("skew=true" in p for p in plans)
    found = {r["sid"]: r["root"] for r in roots.collect()}
    assert all(found[k + 2_000_000] == 0 for k in range(0, 40_000, 2))
    assert all(found[k + 3_000_000] == k + 1_000_000 for k in range(1, 40_000, 2))


def test_equal_rows_are_spread_over_the_token_files(spark, monkeypatch):
    monkeypatch.setattr(orc_tokens, "FILE_BYTES", 20_000)
    frame = docs(spark, [(5, "the very same text again and again")] * 3000 + [(k, f"text {k}") for k in range(200)])
    path = scratch(spark, "tokens") + ".orc"
    out = orc_tokens.report(frame.repartition(4), path)
    sizes = [r["count"] for r in orc_tokens.read(spark, path).groupBy(F.col("_metadata.file_name")).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 1500
    rows = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in out.collect())
    assert len(rows) == 3200 and rows[0][0] == 0
    assert all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:]))
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)


def test_token_files_hold_row_indexes_and_bloom_filters(spark):
    """Stripes carry both streams for the ids, and a look-up reads fewer rows than the file has."""
    frame = spark.range(0, 40_000, 2).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    path = scratch(spark, "tokens") + ".orc"
    orc_tokens.write(frame, path)
    files = [r[0] for r in orc_tokens.read(spark, path).select("_metadata.file_path").distinct().collect()]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    kinds, stripes = set(), 0
    for file in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(
            jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(conf)
        )
        rows = reader.rows()
        for stripe in reader.getStripes():
            stripes += 1
            footer = rows.readStripeFooter(stripe)
            kinds |= {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
        rows.close()
    assert (1, "ROW_INDEX") in kinds and (1, "BLOOM_FILTER_UTF8") in kinds
    # An id between two that are there: within the range of one row group, and in no Bloom filter.
    one = orc_tokens.read(spark, path).where("doc_id = 20002")
    assert one.count() == 1 and orc_tokens.read(spark, path).where("doc_id = 20001").count() == 0
    plan = one._jdf.queryExecution().executedPlan()
    one.collect()
    assert "EqualTo(doc_id,20002)" in plan.toString()
