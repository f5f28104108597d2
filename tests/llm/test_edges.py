"""Empty tables, null columns, clashing names and lonely rows for every llm operator and pipeline stage."""

import pytest

from telemetra.llm import queries as Q

from .conftest import frame

#: The queries of other tables have their edge cases in test_round3.py.
DOCUMENT_QUERIES = sorted(set(Q.QUERIES) - {"op12_hard_negatives", "op13_prefix_trie"})

NULLS = [(None, None, None, None, None), (1, None, None, None, None), (None, "some words in a row", "en", "s", 19),
         (2, "some words in a row", None, None, None), (None, "some words in a row", None, None, None)]


def written(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_empty_table(spark, tmp_path, name):
    got = Q.QUERIES[name](spark, written(spark, frame(spark, []), tmp_path))
    assert got.count() == 0 and got.columns


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_nulls_and_clashing_columns(spark, tmp_path, name):
    sf = written(spark, frame(spark, NULLS, clashing=True), tmp_path)
    got = Q.QUERIES[name](spark, sf).collect()
    assert len(got) == len(NULLS)


def test_pipeline_edges(spark, tmp_path):
    import corpus_pipeline as C

    for rows in ([], NULLS):
        for clashing in (False, True):
            docs = frame(spark, rows, clashing)
            for _, apply in C.STAGES[:-1]:
                columns = docs.columns
                docs = apply(spark, docs, "")
                assert docs.columns == columns
                path = tmp_path / f"{len(rows)}-{clashing}-{len(list(tmp_path.iterdir()))}"
                docs.write.parquet(str(path))
                docs = spark.read.parquet(str(path))
            assert C.STAGES[-1][1](spark, docs, "").count() >= 0


def test_drop_copies_with_other_splits(spark, tmp_path):
    """Other splits between the search for copies and the anti-join: still one row of each text stays."""
    import corpus_pipeline as C

    rows = [(i, f"text number {i % 9}", "en", "s", 13) for i in range(40)]
    docs = spark.read.parquet(written(spark, frame(spark, rows).repartition(8), tmp_path) + "/documents.parquet")
    left = C.drop_copies(spark, docs, "")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    counts = []
    try:
        for cost in ("1", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            counts.append(sorted(r["text"] for r in left.select("*").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert counts == [sorted(f"text number {k}" for k in range(9))] * 2
