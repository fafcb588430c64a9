import pytest

from corpusloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", 4, "4g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluates a column expression over one row of strings."""

    def run(build, *values):
        names = [f"c{i}" for i in range(len(values))]
        row = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
        from pyspark.sql import functions as F

        return row.select(build(*[F.col(n) for n in names]).alias("x")).first()["x"]

    return run
