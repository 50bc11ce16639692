"""Where working tables go."""

from aerocast import session


class Fake:
    """Stands in for a session with other settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, *default):
        return self.settings.get(key, *default) if default else self.settings[key]


def test_named_folder_wins():
    named = Fake(**{"spark.checkpoint.dir": "/shared/work/", "spark.sql.warehouse.dir": "/tables"})
    assert session.shared_dir(named) == "/shared/work"
    assert session.scratch_path(named, "x").startswith("/shared/work/x-")
    assert session.scratch_path(named, "x", "/own/run").startswith("/own/run/x-")


def test_warehouse_without_a_named_folder():
    assert session.shared_dir(Fake(**{"spark.sql.warehouse.dir": "file:/tables/"})) == "file:/tables/aerocast-work"


def test_materialise_keeps_schema_and_rows(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS name")
    stored = session.materialise(df, "test")
    assert stored.dtypes == df.dtypes and stored.exceptAll(df).isEmpty()
