"""The sample that classifiers learn from."""

from rowtide.llm.common import labelled_sample

LABELS = "doc_id long, quality int, toxic int"


def test_an_id_that_repeats_is_one_row(spark, documents):
    rows = [(1, f"text {k}", "en", "a") for k in range(50)] + [(2, None, "en", "a"), (2, "only", "en", "a"), (3, None, "en", "a"), (4, "four", "en", "a")]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in (1, 1, 2, 3, 4)], LABELS)

    def got(rows, most):
        sample = labelled_sample(documents(rows), labels, "toxic", buckets=5, remainder=9, max_rows=most)
        return sorted(map(tuple, sample.collect()), key=str)

    whole = got(rows, 10)
    assert [(r[0], r[2]) for r in whole] == [(1, 1), (2, 0), (3, 1), (4, 0)]
    assert whole[1][1] == "only" and whole[2][1] is None
    assert whole == got(rows[::-1], 10)
    assert len(got(rows, 2)) == 2


def test_the_first_by_hash_is_the_same_with_and_without_a_bound(spark):
    from pyspark.sql import functions as F

    from rowtide.llm.common import first_by_hash

    rows = spark.range(40_000)
    want = [r.id for r in rows.orderBy(F.xxhash64("id"), "id").limit(700).collect()]
    assert [r.id for r in first_by_hash(rows, ["id"], 40_000, 700).collect()] == want
    assert first_by_hash(rows, ["id"], 40_000, 50_000).count() == 40_000
    few = first_by_hash(rows, ["id"], 40_000, 700)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in few.split("Filter")[1]


def test_weights_are_the_labelled_rows_of_a_class(spark, documents):
    labels = spark.createDataFrame([(k, int(k % 5 == 0), 0) for k in range(100)], LABELS)
    docs = documents([(k, f"t{k}", "en", "a") for k in range(100)])
    sample = labelled_sample(docs, labels, "quality", buckets=5, remainder=9, max_rows=20).collect()
    assert sorted((r.label, r.weight) for r in sample) == [(0, 8.0)] * 10 + [(1, 2.0)] * 10
