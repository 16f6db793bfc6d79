import importlib
import re

import corpus_pipeline
from checks.compare import compare, oracle_connection
from stayline.llm.queries import ORACLES, QUERIES
from stayline.llm.simhash import near_duplicates
from stayline.llm.tables import read

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_queries_match_their_oracles(spark):
    connection = oracle_connection(FOLDER)
    for name, sql in ORACLES.items():
        assert compare(spark, connection, FOLDER, QUERIES[name], sql) is None, name


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = read(spark, FOLDER, "documents")
    columns, counts = docs.columns, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, docs, FOLDER)
        frame.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            counts.append(docs.count())
        if name == "simhash_near_dedup":
            groups = [r.component_id for r in near_duplicates(docs).collect()]
            assert len(groups) == len(set(groups))
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    kept = spark.read.parquet(f"{tmp_path}/3").count()
    assert docs.select("doc_id").distinct().count() == kept


def test_empty_table(spark):
    docs = read(spark, FOLDER, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
