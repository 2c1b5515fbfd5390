"""Typing, key checks, loads in one commit, inserts."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rowtide.errors import LoadError
from rowtide.operators import inserts
from rowtide.operators.profile import display, profile
from rowtide.plans import loads
from rowtide.session import stored
from rowtide.specs import SHOP_TABLES, TableSpec

SPEC = TableSpec("t", StructType([StructField("id", IntegerType()), StructField("v", StringType())]), ("id",))


def reasons(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema)


def test_key_clashes(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "x"), (None, "y")])
    assert reasons(inserts.key_clashes(df, ["id"])) == [(1, 2), (None, 2)]


def test_classify_types(spark):
    rows = [("1", "a"), ("x", "b"), ("", "c"), (None, "d"), ("1.0", "e"), (" 7 ", "f")]
    df = spark.createDataFrame(rows, "id string, v string")
    got = {r.v: (r.id, r.bad_columns, r.reject_reason) for r in inserts.classify_types(df, SPEC).collect()}
    assert got == {
        "a": ("1", [], None),
        "b": ("x", ["id"], "bad_type"),
        "c": ("", ["id"], "bad_type"),
        "d": (None, [], "null_key"),
        "e": ("1.0", ["id"], "bad_type"),
        "f": (" 7 ", [], None),
    }


def test_insert_without_arrival_rejects_all_copies(spark):
    got = inserts.classify_keys(
        frame(spark, [(1, "old")]), frame(spark, [(1, "a"), (2, "b"), (3, "c"), (3, "c"), (None, "n")]), SPEC
    )
    assert reasons(got) == [
        (1, "a", "key_exists"),
        (2, "b", None),
        (3, "c", "repeated_in_batch"),
        (3, "c", "repeated_in_batch"),
        (None, "n", "null_key"),
    ]


def test_insert_with_arrival_takes_the_first(spark):
    batch = spark.createDataFrame(
        [(1, "a", 1), (2, "late", 9), (2, "first", 2), (3, "x", 5), (3, "y", 5), (3, "z", 6), (4, "only", None)],
        "id int, v string, at int",
    )
    got = inserts.classify_keys(frame(spark, [(1, "old")]), batch, SPEC, ["at"])
    assert {(r.id, r.v): r.reject_reason for r in got.collect()} == {
        (1, "a"): "key_exists",
        (2, "late"): "repeated_in_batch",
        (2, "first"): None,
        (3, "x"): "ambiguous_arrival",
        (3, "y"): "ambiguous_arrival",
        (3, "z"): "repeated_in_batch",
        (4, "only"): None,
    }


def test_insert_against_one_by_one(spark):
    """Random batches against a loop of single inserts; a third of the batch on one key."""
    rng = random.Random(3)
    held = set(rng.sample(range(400), 120))
    batch = [(7 if rng.random() < 0.33 else rng.randrange(400), str(n), n) for n in range(3000)]
    taken, wanted = set(held), {}
    for key, v, _ in batch:
        wanted[v] = key not in taken
        taken.add(key)
    shuffled = rng.sample(batch, len(batch))
    got = inserts.classify_keys(
        frame(spark, [(k, "h") for k in held]),
        spark.createDataFrame(shuffled, "id int, v string, at int").repartition(6),
        SPEC,
        ["at"],
    )
    assert {r.v: r.reject_reason is None for r in got.collect()} == wanted


def test_a_hot_key_is_split_between_tasks(spark, tmp_path):
    """Beyond the broadcast limit, the rows of a common key are not joined by one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    rows = spark.range(0, 120_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50_000).cast("int").alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    rows.write.parquet(str(tmp_path / "batch"))
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        batch = spark.read.parquet(str(tmp_path / "batch"))
        got = inserts.classify_keys(frame(spark, []), batch, SPEC)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert got.count() == 120_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_the_held_table_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    spark.range(20_000).select(F.col("id").cast("int"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "held"))
    held = spark.read.parquet(str(tmp_path / "held"))
    batch = stored(inserts._batch_keys(frame(spark, [(5, "a"), (90_000, "b")]), ["id"], []), "test")
    known = inserts._known(held, batch, ["id"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi") < plan.index("FileScan")
    assert [r.id for r in known.collect()] == [5]


def put(path, name, text):
    (path / name).write_text(text, encoding="utf-8")
    return str(path / name)


def test_load_once_in_one_commit(spark, tmp_path):
    files = {
        "albumy": put(tmp_path, "a.csv", "idAlbumu,tytul,cena\n1,13,65.50\n2,,95.00\n"),
        "klienci": put(tmp_path, "k.csv", 'idKlienta,imie,telefon\n1,"Kowalski, Łukasz",050\n'),
    }
    root = str(tmp_path / "lake")
    assert loads.load_csv_tables(spark, files, root, "seed") is True
    specs = loads.csv_specs(spark, files)
    assert reasons(loads.read_table(spark, root, specs["albumy"])) == [(1, "13", "65.50"), (2, None, "95.00")]
    assert reasons(loads.read_table(spark, root, specs["klienci"])) == [(1, "Kowalski, Łukasz", "050")]
    assert loads.load_csv_tables(spark, files, root, "seed") is False
    assert loads.read_table(spark, root, specs["albumy"]).count() == 2


@pytest.mark.parametrize(
    "text,problem",
    [
        ("idKlienta,imie\n1,a\n1,b\n", "1 repeated keys"),
        ("idKlienta,imie\nx,a\n,b\n", "2 rows without a usable key"),
    ],
)
def test_a_bad_file_fails_the_load_of_all_tables(spark, tmp_path, text, problem):
    files = {
        "albumy": put(tmp_path, "a.csv", "idAlbumu,tytul\n1,a\n"),
        "klienci": put(tmp_path, "k.csv", text),
    }
    root = str(tmp_path / "lake")
    with pytest.raises(LoadError, match=problem):
        loads.load_csv_tables(spark, files, root, "seed")
    specs = loads.csv_specs(spark, files)
    assert loads.read_table(spark, root, specs["albumy"]).count() == 0
    files["klienci"] = put(tmp_path, "k2.csv", "idKlienta,imie\n1,a\n")
    assert loads.load_csv_tables(spark, files, root, "seed") is True
    assert loads.read_table(spark, root, specs["albumy"]).count() == 1


def test_a_cell_of_another_type_fails_the_load(spark, tmp_path):
    spec = TableSpec("t", StructType([StructField("id", IntegerType()), StructField("n", IntegerType())]), ("id",))
    root = str(tmp_path / "lake")
    bad = put(tmp_path, "bad.csv", "id,n\n1,5\n2,five\n")
    with pytest.raises(Exception, match="n: no int: five"):
        loads.load_csv_tables(spark, {"t": bad}, root, "one", specs={"t": spec})
    assert loads.read_table(spark, root, spec).count() == 0
    good = put(tmp_path, "good.csv", "id,n\n1,5\n2,\n")
    assert loads.load_csv_tables(spark, {"t": good}, root, "one", specs={"t": spec})
    assert reasons(loads.read_table(spark, root, spec)) == [(1, 5), (2, None)]


def test_a_second_load_must_not_repeat_keys(spark, tmp_path):
    root = str(tmp_path / "lake")
    loads.load_csv_tables(spark, {"t": put(tmp_path, "1.csv", "id,v\n1,a\n2,b\n")}, root, "one")
    with pytest.raises(LoadError, match="1 keys already loaded"):
        loads.load_csv_tables(spark, {"t": put(tmp_path, "2.csv", "id,v\n2,c\n3,d\n")}, root, "two")
    assert loads.read_table(spark, root, SPEC).count() == 2
    loads.load_csv_tables(spark, {"t": put(tmp_path, "3.csv", "id,v\n3,d\n")}, root, "three")
    assert loads.read_table(spark, root, SPEC).count() == 3


def test_uncommitted_files_are_not_read(spark, tmp_path):
    root = str(tmp_path / "lake")
    loads.load_csv_tables(spark, {"t": put(tmp_path, "1.csv", "id,v\n1,a\n")}, root, "one")
    loads._stage(frame(spark, [(9, "aborted")]), root, "t", "two.1")
    assert reasons(loads.read_table(spark, root, SPEC)) == [(1, "a")]


def test_numeric_load_ids(spark, tmp_path):
    root = str(tmp_path / "lake")
    for load_id in ("01", "2024"):
        path = put(tmp_path, f"{load_id}.csv", f"id,v\n{int(load_id)},a\n")
        assert loads.load_csv_tables(spark, {"t": path}, root, load_id)
    assert sorted(r.id for r in loads.read_table(spark, root, SPEC).collect()) == [1, 2024]


@pytest.mark.parametrize("name", ["albumy", "klienci", "zamowienia"])
def test_insert_rows(spark, tmp_path, name):
    """One new row, one with a known key, one with a bad id; a repeated insert is refused."""
    spec = TableSpec(name, StructType([StructField(c, IntegerType() if c in SHOP_TABLES[name].key else StringType())
                                       for c in SHOP_TABLES[name].columns]), SHOP_TABLES[name].key)
    root = str(tmp_path / "lake")
    width = len(spec.columns) - 1
    header = ",".join(spec.columns)
    loads.load_csv_tables(spark, {name: put(tmp_path, "s.csv", f"{header}\n1{',a' * width}\n")}, root, "seed")
    text = ", ".join(f"`{c}` string" for c in spec.columns)
    incoming = spark.createDataFrame([(i, *["b"] * width) for i in ("1", "2", "x")], text)
    refused = loads.insert_rows(spark, root, spec, incoming, "insert-1")
    assert sorted((r[0], r.reject_reason) for r in refused.collect() if r[0]) == [(1, "key_exists")]
    assert {r.reject_reason for r in refused.collect()} == {"key_exists", "bad_type"}
    assert sorted(r[0] for r in loads.read_table(spark, root, spec).collect()) == [1, 2]
    with pytest.raises(LoadError):
        loads.insert_rows(spark, root, spec, incoming, "insert-1")


def test_a_table_without_a_key_takes_every_row(spark, tmp_path):
    spec = TableSpec("t", StructType([StructField("v", StringType())]))
    root = str(tmp_path / "lake")
    loads.load_csv_tables(spark, {"t": put(tmp_path, "1.csv", "v\na\na\n")}, root, "one")
    incoming = spark.createDataFrame([("a",), (None,)], "v string")
    assert loads.insert_rows(spark, root, spec, incoming, "two").count() == 0
    assert reasons(loads.read_table(spark, root, spec)) == [("a",), ("a",), ("a",), (None,)]


def test_insert_into_a_table_never_loaded(spark, tmp_path):
    incoming = spark.createDataFrame([("1", "a")], "id string, v string")
    root = str(tmp_path / "lake")
    assert loads.insert_rows(spark, root, SPEC, incoming, "first").count() == 0
    assert reasons(loads.read_table(spark, root, SPEC)) == [(1, "a")]


def test_profile_and_display(spark, capsys):
    df = frame(spark, [(1, "a"), (2, None)])
    assert [tuple(r) for r in profile(df).collect()] == [(0, "id", "int", 2, 2), (1, "v", "string", 1, 2)]
    assert [r.row_count for r in profile(df.limit(0)).collect()] == [0, 0]
    display(df, "t", rows=1)
    assert "only showing top 1 row" in capsys.readouterr().out


@pytest.mark.parametrize("load_id", ["a%41", "a/b", "", "a b", "ł"])
def test_ids_that_a_folder_would_not_keep_are_refused(spark, tmp_path, load_id):
    text = spark.createDataFrame([("1", "a")], "id string, v string")
    with pytest.raises(LoadError, match="load id"):
        loads.insert_rows(spark, str(tmp_path), SPEC, text, load_id)
    with pytest.raises(LoadError, match="load id"):
        loads.load_csv_tables(spark, {}, str(tmp_path), load_id)


def test_append_binds_by_name(spark, tmp_path):
    from rowtide.errors import SchemaError
    from rowtide.sources import tables

    swapped = TableSpec("swapped", StructType([StructField("b", StringType()), StructField("a", StringType())]))
    tables.create_table(spark, swapped, str(tmp_path / "swapped"))
    named = TableSpec("swapped", StructType([StructField("a", StringType()), StructField("b", StringType())]))
    tables.append_table(spark.createDataFrame([("in-a", "in-b")], "a string, b string"), named)
    assert [(r.a, r.b) for r in spark.table("swapped").collect()] == [("in-a", "in-b")]
    other = TableSpec("swapped", StructType([StructField("a", StringType()), StructField("c", StringType())]))
    with pytest.raises(SchemaError):
        tables.append_table(spark.createDataFrame([("x", "y")], "a string, c string"), other)


@pytest.mark.parametrize(
    ("text", "value"),
    [("12d", None), ("12f", None), ("1e5", 1e5), ("NaN", "nan"), (" 7 ", 7.0), ("", None), (" ", None), (".5", 0.5), ("5.", 5.0), ("-inf", float("-inf")), ("0x1", None), ("1,5", None)],
)
def test_text_of_a_floating_column(spark, text, value):
    from rowtide.functions.typed import bad_columns, typed_columns
    from pyspark.sql.types import DoubleType

    schema = StructType([StructField("x", DoubleType())])
    row = spark.createDataFrame([(text,)], "x string").select(*typed_columns(schema), bad_columns(schema).alias("bad")).first()
    assert (row.x == value) or (value == "nan" and row.x != row.x)
    assert row.bad == ([] if value is not None else ["x"])


def test_a_batch_is_read_twice(spark, tmp_path):
    """Once for its keys, which is stored, and once for the verdicts."""
    text = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("2", "d"), ("2", "e")], "id string, v string")
    text.write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    got = inserts.insertable(frame(spark, [(1, "old")]), batch, SPEC)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [id#") <= 2
    assert reasons(got) == sorted(
        [(1, "a", "key_exists"), (None, "b", "bad_type"), (None, "c", "null_key"), (2, "d", "repeated_in_batch"), (2, "e", "repeated_in_batch")],
        key=repr,
    )


def test_an_id_with_a_meaning_of_its_own_as_a_folder(spark, tmp_path):
    root = str(tmp_path / "lake")
    odd = "__HIVE_DEFAULT_PARTITION__"
    assert loads.load_csv_tables(spark, {"t": put(tmp_path, "1.csv", "id,v\n1,a\n")}, root, odd)
    assert reasons(loads.read_table(spark, root, SPEC)) == [(1, "a")]
    assert loads.load_csv_tables(spark, {"t": put(tmp_path, "2.csv", "id,v\n2,a\n")}, root, odd) is False


@pytest.fixture
def small_blocks(spark):
    """Files are read in blocks of a few rows, several blocks to a task."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rows_in_load_order(spark, tmp_path, small_blocks):
    """Several files, cut in blocks, two loads and an insert; keys say nothing about the order."""
    rng = random.Random(9)
    keys = rng.sample(range(10_000), 1200)
    spec = TableSpec("t", StructType([StructField("id", IntegerType()), StructField("number", StringType())]), ("id",))
    written = []
    root = str(tmp_path / "lake")
    for load_id, part in (("one", keys[:700]), ("two", keys[700:])):
        folder = tmp_path / load_id
        folder.mkdir()
        for n, start in enumerate(range(0, len(part), 150)):
            rows = part[start : start + 150]
            written += rows
            put(folder, f"part-{n}.csv", "id,number\n" + "".join(f"{k},{'x' * rng.randrange(30)}\n" for k in rows))
        assert loads.load_csv_tables(spark, {"t": str(folder)}, root, load_id, specs={"t": spec})
    got = loads.read_in_order(spark, root, spec).orderBy("ordinal").collect()
    assert [r.id for r in got] == written
    assert [r.ordinal for r in got] == list(range(1, 1201))
    late = spark.createDataFrame([("x", "bad"), ("20000", "a"), (str(keys[0]), "again"), ("20001", "b")], "id string, number string").coalesce(1)
    assert loads.insert_rows(spark, root, spec, late, "three").count() == 2
    got = loads.read_in_order(spark, root, spec).orderBy("ordinal").collect()
    assert [r.id for r in got[:1200]] == written and sorted(r.id for r in got[1200:]) == [20000, 20001]
    assert len({r.ordinal for r in got}) == len(got) == loads.read_table(spark, root, spec).count()


def test_an_empty_load_has_an_order(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert loads.read_in_order(spark, root, SPEC).collect() == []
    assert loads.load_csv_tables(spark, {"t": put(tmp_path, "1.csv", "id,v\n")}, root, "one", specs={"t": SPEC})
    assert loads.read_in_order(spark, root, SPEC).collect() == []


def test_two_writers_of_one_key(spark, tmp_path):
    """Both judge the same table before either commits; one is accepted, the other sees its key."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    root = str(tmp_path / "lake")
    loads.load_csv_tables(spark, {"t": put(tmp_path, "1.csv", "id,v\n1,a\n")}, root, "seed")
    together, put_commit, tries = Barrier(2, timeout=60), loads.put_commit, []

    def at_once(s, folder, number, content):
        tries.append(number)
        if number == 2:
            together.wait()
        return put_commit(s, folder, number, content)

    def insert(name):
        batch = spark.createDataFrame([("5", name), ("6" if name == "x" else "7", name)], "id string, v string")
        return [tuple(r) for r in loads.insert_rows(spark, root, SPEC, batch, name).collect()]

    loads.put_commit = at_once
    try:
        with ThreadPoolExecutor(2) as pool:
            refused = sorted(sum(pool.map(insert, ["x", "y"]), []))
    finally:
        loads.put_commit = put_commit
    assert sorted(tries) == [2, 2, 3]
    assert len(refused) == 1 and refused[0][0] == 5 and refused[0][2] == "key_exists"
    rows = reasons(loads.read_table(spark, root, SPEC))
    assert sorted(r[0] for r in rows) == [1, 5, 6, 7]
    assert (5, refused[0][1]) not in rows


def test_two_loads_of_one_id_and_of_one_key(spark, tmp_path):
    """What another writer commits between the check and the commit is checked again."""
    root = str(tmp_path / "lake")
    path = put(tmp_path, "1.csv", "id,v\n1,a\n")
    put_commit = loads.put_commit

    def late(between):
        def put_late(s, folder, number, content):
            loads.put_commit = put_commit
            between()
            return put_commit(s, folder, number, content)

        loads.put_commit = put_late

    late(lambda: loads.load_csv_tables(spark, {"t": path}, root, "same"))
    assert loads.load_csv_tables(spark, {"t": path}, root, "same") is False
    other = put(tmp_path, "2.csv", "id,v\n2,b\n3,b\n")
    again = put(tmp_path, "3.csv", "id,v\n2,c\n")
    late(lambda: loads.load_csv_tables(spark, {"t": again}, root, "first"))
    with pytest.raises(LoadError, match="1 keys already loaded"):
        loads.load_csv_tables(spark, {"t": other}, root, "second")
    assert reasons(loads.read_table(spark, root, SPEC)) == [(1, "a"), (2, "c")]
    assert [r.load_id for r in loads.commits(spark, root).orderBy("number").collect()] == ["same", "first"]


def test_a_judged_batch_is_written_once(spark, tmp_path):
    """The rows of the load are the verdicts; nothing of the batch is stored beside them."""
    root = tmp_path / "lake"
    batch = spark.createDataFrame([("1", "a", 2), ("1", "b", 1), ("x", "c", 3)], "id string, v string, at int")
    refused = loads.insert_rows(spark, str(root), SPEC, batch, "one", ["at"])
    assert reasons(refused) == [(1, "a", 2, "repeated_in_batch"), (None, "c", 3, "bad_type")]
    parts = [p.name for p in (root / "t").iterdir()]
    assert len(parts) == 1 and parts[0].startswith("load_part=one.")
    assert spark.read.parquet(str(root / "t")).count() == 3
    assert reasons(loads.read_table(spark, str(root), SPEC)) == [(1, "b")]
