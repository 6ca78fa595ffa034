import json

import pytest

from tidewell import __main__ as cli
from tidewell.errors import StoreError
from tidewell.plans import ddl
from tidewell.schemas import TABLES
from tidewell.settings import settings
from tidewell.sources.landing import Landing
from tidewell.streaming import log
from tests.test_landing import record


def test_catalog_tables(spark):
    names = ddl.create_all(spark, "lake")
    assert ddl.create_all(spark, "lake") == names and len(names) == len(TABLES)
    try:
        for name, schema in zip(names, TABLES.values(), strict=True):
            assert [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        row = "select 'f' shape_fingerprint, 'v' schema_version, '[]' unknown_fields_json, 'o' occurrence_id, cast(null as string) sample_rejection_reason, cast(null as timestamp_ntz) first_seen_at"
        for _ in range(2):
            ddl.insert_new(spark, "lake.schema_observations", spark.sql(row), ["shape_fingerprint"])
        assert spark.table("lake.schema_observations").count() == 1
        with ddl.empty_clone(spark, "lake.schema_observations") as clone:
            assert spark.table(clone).count() == 0
            ddl.insert_values(spark, clone, shape_fingerprint="it's", first_seen_at="2024-01-01 00:00:00")
            assert spark.table(clone).first().shape_fingerprint == "it's"
        assert not spark.catalog.tableExists(clone)
        assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("incoming_")]
    finally:
        spark.sql("DROP DATABASE IF EXISTS lake CASCADE")


@pytest.mark.parametrize("bad", ["x; drop table y", "A.b", "a.b.c.d", "", "a b"])
def test_names_are_checked(spark, bad):
    with pytest.raises(StoreError):
        ddl.identifier(bad)
    with pytest.raises(StoreError):
        ddl.identifier("fine", {"other"})


def test_command_line(tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("TIDEWELL_LANDING_ROOT", str(tmp_path / "landing"))
    monkeypatch.setenv("TIDEWELL_MIN_FREE_MB", "0")
    settings.cache_clear()
    try:
        folder, _ = Landing(tmp_path / "landing").write([record(1)])
        assert cli.main(["publish", str(tmp_path / "out"), "--once", "--dry-run"]) == 0 and not (tmp_path / "out").exists()
        assert cli.main(["publish", str(tmp_path / "out"), "--once"]) == 0
        assert capsys.readouterr().out.strip() == folder.name and (tmp_path / "out" / folder.name / "manifest.json").exists()
        assert cli.main(["cleanup"]) == 0
        with pytest.raises(SystemExit):
            cli.main(["nothing"])
    finally:
        settings.cache_clear()


def test_smoke_messages(spark):
    rows = log.smoke_messages(spark).unionByName(spark.createDataFrame([("k", "{"), ("k", "[1]"), ("k", None)], "key string, value string"))
    assert [json.loads(r.value)["number"] for r in log.well_formed(rows).collect()] == [0, 1, 2, 3, 4]


def test_inspection_stream(spark, tmp_path):
    log.smoke_messages(spark).write.json(f"{tmp_path}/in")
    seen = []
    stream = spark.readStream.schema("key string, value string").json(f"{tmp_path}/in")
    query = log.inspect(stream, f"{tmp_path}/c", seconds=0.1, printer=seen.append)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(seen) == 5
