import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("retailflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path, request):
    """A database of its own for one test."""
    from retailflow.sources import ensure_database

    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    ensure_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def conf(spark):
    """Set a Spark setting for one test."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)
