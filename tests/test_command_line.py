"""The command line, in process; the Kafka jobs run on a stored log."""

import pytest

import rowtide.__main__ as cli
from rowtide.operators.encode import to_records
from rowtide.sources.kafka import append_log, stored_stream
from rowtide.specs import SHOP_TABLES, topic_of
from rowtide.streaming.sink import lake_path


@pytest.fixture
def shop(tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    (data / "albumy.csv").write_text(
        "idAlbumu,tytul,wykonawca,gatunek,wytwornia,dataWydania,cena\n1,T,W,G,L,2001-02-03,10.50\n", encoding="utf-8"
    )
    (data / "klienci.csv").write_text("idKlienta,imie,nazwisko,telefon,email\n1,Łucja,N,050,l@x.pl\n", encoding="utf-8")
    (data / "zamowienia.csv").write_text(
        'idZamowienia,KlientId,AlbumId,adresDostawy,dataZlozeniaZamowienia\n1,1,1,"ul. A 1, Łódź",2024-03-01\n',
        encoding="utf-8",
    )
    return str(data), str(tmp_path / "lake")


def test_load_show_insert_profile(spark, shop, capsys):
    data, root = shop

    def call(*argv):
        code = cli.main(argv, spark)
        return code, capsys.readouterr().out

    assert "All tables loaded" in call("load", "--data", data, "--root", root)[1]
    assert "nothing done" in call("load", "--data", data, "--root", root)[1]
    text = call("show", "--root", root)[1]
    assert "10.50" in text and "Łucja" in text and "ul. A 1, Łódź" in text
    row = ["idKlienta=2", "imie=Jan", "nazwisko=K", "telefon=1", "email=j@x.pl"]
    assert call("insert", "--root", root, "klienci", *row) == (0, "[OK] Row added to klienci.\n")
    assert call("insert", "--root", root, "klienci", *row)[0] == 1
    assert "key_exists" in call("insert", "--root", root, "klienci", "idKlienta=1")[1]
    for _ in range(2):
        assert "bad_type" in call("insert", "--root", root, "klienci", "idKlienta=x")[1]
    assert "null_key" in call("insert", "--root", root, "klienci", "imie=x")[1]
    assert "no columns" in call("insert", "--root", root, "klienci", "id=1")[1]
    assert "Jan" in call("show", "--root", root, "klienci")[1]
    assert "klienci" not in call("show", "--root", root, "albumy")[1]
    assert "empty" in call("show", "--root", f"{root}-none", "albumy")[1]
    assert call("show", "--root", root, "other")[0] == 2
    assert "idAlbumu" in call("profile", f"{root}/albumy")[1]


def test_lake_job(spark, shop, tmp_path, monkeypatch, capsys):
    """The stored log stands in for the broker; the wait ends at once instead of never."""
    root, log = shop[1], str(tmp_path / "log")
    spec = SHOP_TABLES["klienci"]
    rows = spark.createDataFrame([(1, "Łucja", "N", "050", "l@x.pl")], spec.schema).selectExpr("*", "1 as n")
    append_log(to_records(rows, spec.key, topic_of("klienci"), "n"), log)
    asked = []
    monkeypatch.setattr(cli, "kafka_stream", lambda s, options: asked.append(options) or stored_stream(s, log))
    monkeypatch.setattr(cli, "await_any", lambda s: [q.processAllAvailable() for q in s.streams.active])
    assert cli.main(["lake", "--root", root, "--servers", "h:1", "--trigger", "1 second", "klienci"], spark) == 0
    assert "Streams ready: klienci" in capsys.readouterr().out
    assert asked[0]["subscribe"] == "dbserver1.public.klienci"
    assert asked[0]["maxOffsetsPerTrigger"] == "1000000" and asked[0]["failOnDataLoss"] == "false"
    assert [r.imie for r in spark.read.parquet(lake_path(root, "klienci")).collect()] == ["Łucja"]
    assert spark.streams.active == []


@pytest.mark.parametrize("to_files", [False, True])
def test_monitor_shows_every_message(spark, tmp_path, monkeypatch, capfd, to_files):
    log = str(tmp_path / "log")
    spec = SHOP_TABLES["klienci"]
    rows = spark.createDataFrame([(i, "Łucja", "N", "050", "l@x.pl") for i in range(50)], spec.schema).selectExpr("*", "idKlienta as n")
    append_log(to_records(rows, spec.key, topic_of("klienci"), "n"), log)
    seen = []
    monkeypatch.setattr(cli, "kafka_stream", lambda s, options: stored_stream(s, log))

    def wait(s):
        for query in s.streams.active:
            query.processAllAvailable()
            seen.append(query.lastProgress.numInputRows)

    monkeypatch.setattr(cli, "await_any", wait)
    out = ["--out", str(tmp_path / "out")] if to_files else []
    assert cli.main(["monitor", "--checkpoint", str(tmp_path / "c"), "--trigger", "1 second", *out], spark) == 0
    assert len(seen) == 1
    shown = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) if to_files else capfd.readouterr().out
    assert [shown.count(f'"idKlienta": {i},') for i in range(50)] == [1] * 50
