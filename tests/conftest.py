import pytest

from bidloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session


@pytest.fixture
def rows_of():
    return lambda df, *cols: {tuple(r) for r in (df.select(*cols) if cols else df).collect()}
