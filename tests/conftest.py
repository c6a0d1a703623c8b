import pytest
from pyspark.sql import SparkSession

from termloom import build_index, corpus_from_records, field_params, parse_records

# The golden corpus: two fields, of which some are empty or absent.
GOLDEN = [
    '{"docid":"d1","title":"Red Fox","body":"The quick red fox"}',
    '{"docid":"d2","title":"Blue fox!","body":"fox -- fox den"}',
    '{"docid":"d3","title":"","body":"the den"}',
    '{"docid":"d4","body":"red"}',
    '{"docid":"d5"}',
]
ALIASES = {"title": "t", "body": "b"}
PARAMS = field_params({"t": 1.0, "b": 0.5}, {"t": 1.2, "b": 1.2}, {"t": 0.75, "b": 0.75})


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("termloom-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans tell their filters in full, however long the numbers of their columns are.
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def json_corpus(spark, lines, aliases=ALIASES):
    rows = [(str(i), line) for i, line in enumerate(lines)]
    records = spark.createDataFrame(rows, "path string, content string")
    return corpus_from_records(parse_records(records, aliases))


@pytest.fixture(scope="session")
def golden(spark):
    index = build_index(json_corpus(spark, GOLDEN))
    for table in (index.postings, index.lengths, index.field_stats, index.corpus_stats):
        table.cache()
    return index
