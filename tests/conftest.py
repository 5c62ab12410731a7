import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                            spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(df) -> sorted list of tuples; frame(schema, *rows) -> DataFrame spread over partitions."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect


@pytest.fixture
def frame(spark):
    def make(schema, *data, parts=3):
        return spark.createDataFrame(list(data), schema).repartition(parts)
    return make
