"""Scans, header schemas, loads, profiles and keyed inserts."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.typed import as_text_frame
from rowtide.operators import inserts
from rowtide.operators.profile import profile
from rowtide.plans.loads import insert_rows, load_csv_tables, read_in_order, read_table
from rowtide.queries.inputs import spec_of, table
from rowtide.session import work_dir
from rowtide.sources import files
from rowtide.sources import tables as catalog
from rowtide.specs import TableSpec

LOADED = ("customer", "part", "orders")
# CSV files of a load whose order matters.
LOAD_FILES = 5


def write_csv(df: DataFrame, path: str) -> str:
    """A CSV copy of a table: all cells as text, quotes doubled."""
    as_text_frame(df).write.options(
        **files.CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return path


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/orders.parquet")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = write_csv(customer, f"{work_dir(spark, 'csv')}/customer")
    return files.read_csv_table(spark, path, spec_of(customer, "customer"))


def header_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from the header: the renamed key becomes an integer, all else stays text."""
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "idCustomer")
    path = write_csv(customer, f"{work_dir(spark, 'header')}/customer")
    spec = files.csv_specs(spark, {"customer": path})["customer"]
    return files.read_csv_table(spark, path, spec)


def all_tables_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables loaded from CSV in one commit, then scanned in turn."""
    root = work_dir(spark, "load")
    source = {name: table(spark, sf_dir, name) for name in LOADED}
    specs = {name: spec_of(df, name) for name, df in source.items()}
    paths = {name: write_csv(df, f"{root}/csv/{name}") for name, df in source.items()}
    load_csv_tables(spark, paths, f"{root}/lake", "seed", specs=specs)
    scanned = []
    for name, spec in specs.items():
        rows = read_table(spark, f"{root}/lake", spec)
        row_text = F.concat_ws("|", *[F.col(c).cast("string") for c in spec.columns])
        scanned.append(rows.select(F.lit(name).alias("table_name"), F.col(spec.key[0]).alias("id"), row_text.alias("row")))
    return reduce(DataFrame.unionAll, scanned)


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "orders"))


def bulk_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created once, a second create without effect, then a bulk append."""
    part = table(spark, sf_dir, "part")
    spec = TableSpec(f"part_{uuid.uuid4().hex}", part.schema, ("p_partkey",))
    location = f"{work_dir(spark, 'append')}/part"
    catalog.create_table(spark, spec, location)
    catalog.append_table(part, spec)
    catalog.create_table(spark, spec, location)
    return catalog.scan(spark, spec.name)


def key_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inserts.key_clashes(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the second half of 1999 and later, against a table of those before 2000."""
    orders = table(spark, sf_dir, "orders")
    placed = F.col("o_orderdate")
    held = orders.where(placed < F.lit("2000-01-01").cast("timestamp_ntz"))
    batch = orders.where(placed >= F.lit("1999-07-01").cast("timestamp_ntz"))
    return inserts.classify_keys(held, batch, spec_of(orders, "orders"))


def insert_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inserts.accepted(order_batch(spark, sf_dir))


def insert_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inserts.rejected(order_batch(spark, sf_dir))


def insert_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as one batch into an empty table: of each key the first by ship date, part and supplier."""
    lines = table(spark, sf_dir, "lineitem")
    spec = spec_of(lines, "lineitem")
    empty = spark.createDataFrame([], spec.schema)
    return inserts.classify_keys(empty, lines, spec, ["l_shipdate", "l_partkey", "l_suppkey"])


def insert_bad_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers typed in as text: some ids with a letter in front, some left out."""
    customer = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    typed_in = as_text_frame(customer).withColumn(
        "c_custkey",
        F.when(segment == "BUILDING", F.concat(F.lit("C"), F.col("c_custkey")))
        .when(segment == "AUTOMOBILE", F.lit(None))
        .otherwise(F.col("c_custkey")),
    )
    flagged = inserts.classify_types(typed_in, spec_of(customer, "customer"))
    return flagged.select("c_custkey", "c_name", "c_acctbal", F.array_join("bad_columns", ",").alias("bad"), "reject_reason")


def insert_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after a seed load and the insert of a batch that overlaps it."""
    root = work_dir(spark, "insert")
    orders = table(spark, sf_dir, "orders")
    spec = spec_of(orders, "orders")
    placed = F.col("o_orderdate")
    seed = orders.where(placed < F.lit("2000-01-01").cast("timestamp_ntz"))
    path = write_csv(seed, f"{root}/csv/orders")
    load_csv_tables(spark, {"orders": path}, f"{root}/lake", "seed", specs={"orders": spec})
    batch = orders.where(placed >= F.lit("1999-07-01").cast("timestamp_ntz"))
    insert_rows(spark, f"{root}/lake", spec, as_text_frame(batch), "late")
    return read_table(spark, f"{root}/lake", spec)


def load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of several files each, older orders second, with the place of every row in load order."""
    root = work_dir(spark, "order")
    orders = table(spark, sf_dir, "orders")
    spec = spec_of(orders, "orders")
    newer = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    for load_id, part in (("newer", orders.where(newer)), ("older", orders.where(~newer))):
        files = part.repartitionByRange(LOAD_FILES, "o_orderkey").sortWithinPartitions("o_orderkey")
        path = write_csv(files, f"{root}/csv/{load_id}")
        load_csv_tables(spark, {"orders": path}, f"{root}/lake", load_id, specs={"orders": spec})
    return read_in_order(spark, f"{root}/lake", spec)


QUERIES = {
    "parquet_scan": parquet_scan,
    "csv_round_trip": csv_round_trip,
    "header_schema": header_schema,
    "all_tables_scan": all_tables_scan,
    "table_profile": table_profile,
    "bulk_append": bulk_append,
    "key_clashes": key_clashes,
    "insert_accepted": insert_accepted,
    "insert_rejected": insert_rejected,
    "insert_first_wins": insert_first_wins,
    "insert_bad_types": insert_bad_types,
    "insert_committed": insert_committed,
    "load_order": load_order,
}

SQL = {
    "parquet_scan": "select * from orders",
    "csv_round_trip": "select * from customer",
    "header_schema": """
        select cast(c_custkey as integer) as "idCustomer", c_name,
               cast(c_nationkey as varchar) as c_nationkey,
               cast(c_acctbal as varchar) as c_acctbal, c_mktsegment
        from customer""",
    "all_tables_scan": """
        select 'customer' as table_name, c_custkey as id,
               concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) as row from customer
        union all
        select 'part', p_partkey, concat_ws('|', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) from part
        union all
        select 'orders', o_orderkey,
               concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)
        from orders""",
    "table_profile": """
        with n as (
          select count(*) as row_count, count(o_orderkey) as c0, count(o_custkey) as c1, count(o_orderstatus) as c2,
                 count(o_totalprice) as c3, count(o_orderdate) as c4, count(o_orderpriority) as c5 from orders)
        select 0 as position, 'o_orderkey' as column_name, 'bigint' as data_type, c0 as non_null, row_count from n
        union all select 1, 'o_custkey', 'bigint', c1, row_count from n
        union all select 2, 'o_orderstatus', 'string', c2, row_count from n
        union all select 3, 'o_totalprice', 'double', c3, row_count from n
        union all select 4, 'o_orderdate', 'timestamp_ntz', c4, row_count from n
        union all select 5, 'o_orderpriority', 'string', c5, row_count from n""",
    "bulk_append": "select * from part",
    "key_clashes": """
        select l_orderkey, l_linenumber, count(*) as copies from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "insert_accepted": """
        select * from orders b
        where o_orderdate >= timestamp '1999-07-01'
          and not exists (select 1 from orders h
                          where h.o_orderdate < timestamp '2000-01-01' and h.o_orderkey = b.o_orderkey)""",
    "insert_rejected": """
        select *, 'key_exists' as reject_reason from orders b
        where o_orderdate >= timestamp '1999-07-01'
          and exists (select 1 from orders h
                      where h.o_orderdate < timestamp '2000-01-01' and h.o_orderkey = b.o_orderkey)""",
    "insert_first_wins": """
        select * exclude (nth, ties), case when nth > 1 then 'repeated_in_batch'
                                           when ties > 1 then 'ambiguous_arrival' end as reject_reason
        from (select *,
                     rank() over (partition by l_orderkey, l_linenumber
                                  order by l_shipdate, l_partkey, l_suppkey) as nth,
                     count(*) over (partition by l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey) as ties
              from lineitem)""",
    "insert_bad_types": """
        with typed_in as (
          select case c_mktsegment when 'BUILDING' then 'C' || c_custkey when 'AUTOMOBILE' then null
                      else cast(c_custkey as varchar) end as c_custkey,
                 c_name, cast(c_acctbal as varchar) as c_acctbal from customer)
        select c_custkey, c_name, c_acctbal,
               case when c_custkey is not null and try_cast(c_custkey as bigint) is null
                    then 'c_custkey' else '' end as bad,
               case when c_custkey is null then 'null_key'
                    when try_cast(c_custkey as bigint) is null then 'bad_type' end as reject_reason
        from typed_in""",
    "insert_committed": "select * from orders",
    "load_order": """
        select *, row_number() over (order by o_orderdate < timestamp '2000-01-01', o_orderkey) as ordinal from orders""",
}
