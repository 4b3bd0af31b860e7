import pytest

from roadstream import schemas
from roadstream.session import local_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "4", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder}
    )
    yield session
    session.stop()


@pytest.fixture
def passages(spark):
    """Build passages from (action_time, monitor, camera, car, speed[, road, area])."""

    def build(*rows):
        full = [(*row, *("r1", "a1")[len(row) - 5 :]) for row in rows]
        return spark.createDataFrame(full, schemas.PASSAGE)

    return build


@pytest.fixture
def monitors(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), schemas.MONITOR)

    return build


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
