from pagemill.plans.publish import COLUMNS, publish_corpus
from pagemill.session import new_table_path
from pagemill.sources.warc import read_warc
from workload.archives import warc_files

SF_DIR = "/root/testdata/sf0.001"


def test_published_table(spark):
    target = new_table_path(spark, "publish-test")
    corpus, model = publish_corpus(read_warc(spark, warc_files(spark, SF_DIR)), target)
    assert set(corpus.columns) == set(COLUMNS)
    rows = corpus.collect()
    assert rows and all(len(r["content_embedded"]) == 5 and len(r["content_idf"]) == 20 for r in rows)
    assert all(len(r["body_content"]) <= 10 for r in rows)
    again = publish_corpus(read_warc(spark, warc_files(spark, SF_DIR)), target)[0]
    assert again.count() == len(rows)
    plan = corpus.filter("content_type = 'pdf'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(content_type" in plan
