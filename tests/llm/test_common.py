"""What a Python worker keeps, and the session setting of text batches."""

from reelrank.llm import common


def test_a_worker_keeps_one_thing(monkeypatch):
    monkeypatch.setattr(common, "_KEPT", {})
    made = []
    make = lambda: made.append(1) or len(made)
    assert common.kept("a", make) == 1 and common.kept("a", make) == 1
    assert common.kept("b") is None and list(common._KEPT) == ["b"]
    assert common.kept("a", make) == 2


def test_text_batches_only_lower_the_bound(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, want in (("10000", "1000"), ("200", "200"), ("0", "1000")):
            spark.conf.set(name, given)
            common.text_batches(spark)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
