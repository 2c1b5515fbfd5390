"""Numbered commits."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql.types import LongType, StringType, StructField, StructType

from rowtide.sources.commits import is_taken, last_commit, put_commit, read_commit, read_commits

SCHEMA = StructType([StructField("number", LongType()), StructField("by", StringType())])


def test_a_number_is_taken_once(spark, tmp_path):
    folder = str(tmp_path / "commits")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda by: put_commit(spark, folder, 1, {"by": str(by)}), range(16)))
    assert sum(won) == 1
    assert read_commit(spark, folder, 1)["by"] == str(won.index(True))
    assert [tuple(r) for r in read_commits(spark, folder, SCHEMA).collect()] == [(1, str(won.index(True)))]


def test_the_last_number_is_found(spark, tmp_path):
    folder = str(tmp_path / "commits")
    assert last_commit(spark, folder) == 0 and read_commits(spark, folder, SCHEMA).collect() == []
    for number in range(1, 20):
        assert put_commit(spark, folder, number, {"by": "a"})
        assert last_commit(spark, folder) == number
    assert is_taken(spark, folder, 19) and not is_taken(spark, folder, 20)
    assert not put_commit(spark, folder, 7, {"by": "b"})
    assert sorted(r.number for r in read_commits(spark, folder, SCHEMA).collect()) == list(range(1, 20))


def test_drafts_are_not_commits(spark, tmp_path):
    folder = tmp_path / "commits"
    put_commit(spark, str(folder), 1, {"by": "a"})
    put_commit(spark, str(folder), 1, {"by": "b"})
    (folder / "_draft").write_text('{"number": 2')
    assert [p.name for p in folder.iterdir() if not p.name.startswith("_")] == ["000000000001.json"]
    assert read_commits(spark, str(folder), SCHEMA).count() == 1
