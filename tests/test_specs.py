import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from rowtide.errors import SchemaError
from rowtide.specs import SHOP_TABLES, TableSpec, spec_from_header, topic_of


@pytest.mark.parametrize("key", ["idAlbumu", "ID", "Id_x", "identity"])
def test_id_header_is_integer_key(key):
    spec = spec_from_header("t", ["a", key, "KlientId"])
    assert spec.key == (key,)
    assert [type(f.dataType) for f in spec.schema] == [StringType, IntegerType, StringType]


def test_header_without_id_has_no_key():
    assert spec_from_header("t", ["a", "b"]).key == ()


def test_two_id_columns_are_an_error():
    with pytest.raises(SchemaError, match="more than one key"):
        spec_from_header("t", ["idA", "idB"])


def test_repeated_columns_are_an_error():
    with pytest.raises(SchemaError, match="repeated"):
        spec_from_header("t", ["a", "a"])


def test_key_must_be_in_the_schema():
    with pytest.raises(SchemaError):
        TableSpec("t", StructType(), ("id",))


def test_shop_tables():
    assert {n: len(s.columns) for n, s in SHOP_TABLES.items()} == {"albumy": 7, "klienci": 5, "zamowienia": 5}
    assert SHOP_TABLES["albumy"].schema["cena"].dataType == DoubleType()
    assert SHOP_TABLES["zamowienia"].schema["KlientId"].dataType == StringType()
    assert all(f.nullable for s in SHOP_TABLES.values() for f in s.schema)


def test_declared_and_header_schemas_agree_on_the_key():
    for name, spec in SHOP_TABLES.items():
        assert spec_from_header(name, spec.columns).key == spec.key


def test_topic():
    assert topic_of("klienci") == "dbserver1.public.klienci"
    assert topic_of("t", "p", "s") == "p.s.t"
