import pytest

from fixtures import star as fx
from patronage.__main__ import main, set_shuffle_width
from patronage.plans.ingest import ingest

SF_DIR = "/root/testdata/sf0.001"


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    source, base, out = (str(tmp_path / name) for name in ("source", "base", "out"))
    tables = fx.tables(spark, SF_DIR)
    ingest(spark, tables.__getitem__, list(tables), source, at_once=4)
    main(["ingest", "--source", source, "--base", base, "--at-once", "4"])
    assert "customer: 150 rows" in capsys.readouterr().out
    main(["customer-360", "--base", base, "--out", f"{out}/profiles"])
    main(["customer-360", "--base", base, "--out", f"{out}/clean", "--clean"])
    main(["customer-analytics", "--base", base, "--out", f"{out}/analytics", "--returns-mode", "joined"])
    spark.sql(f"CREATE DATABASE mall LOCATION '{tmp_path}/mall'")
    main(["customer-analytics", "--base", base, "--out-table", "mall.features", "--returns-mode", "per_channel"])
    assert spark.table("mall.features").count() == spark.read.parquet(f"{out}/analytics").count()
    scratch = tmp_path / "scratch"
    scratch.mkdir()
    main(["features", "--table", "mall.features", "--out", f"{out}/named", "--scratch", str(scratch)])
    assert len(spark.read.parquet(f"{out}/named").columns) == 29
    main(["ingest-catalog", "--database", "mall", "--base", f"{base}-mall", "--run", "once"])
    assert "features: " in capsys.readouterr().out
    spark.sql("DROP DATABASE mall CASCADE")
    main(["features", "--table", f"{out}/analytics", "--out", f"{out}/features", "--scratch", str(scratch)])
    assert list(scratch.iterdir()) == []
    widths = {
        name: len(spark.read.parquet(f"{out}/{name}").columns)
        for name in ("profiles", "clean", "analytics", "features")
    }
    assert widths == {"profiles": 42, "clean": 35, "analytics": 33, "features": 29}
    assert spark.read.parquet(f"{out}/profiles").count() == 150


def test_a_job_is_needed():
    with pytest.raises(SystemExit):
        main([])


def test_the_returns_mode_is_a_choice():
    with pytest.raises(SystemExit):
        main(["customer-analytics", "--base", "x", "--out", "y"])


def test_shuffle_width_follows_the_input():
    class Fake:
        """A session of which only the width matters."""

        def __init__(self, given):
            self.given, self.set_to = given, {}
            self.sparkContext = self.conf = self
            self.defaultParallelism = 8

        def getConf(self):
            return self.given

        def set(self, key, value):
            self.set_to[key] = value

    class Given(dict):
        contains = dict.__contains__

    free, fixed = Fake(Given()), Fake(Given({"spark.sql.shuffle.partitions": "9"}))
    for session in (free, fixed):
        set_shuffle_width(session, [])
    assert free.set_to == {"spark.sql.shuffle.partitions": "200"} and fixed.set_to == {}
