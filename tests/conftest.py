import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedloom.session import build_session  # noqa: E402
from feedloom.sources import schemas  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, {"spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return connection


DAY = date(2024, 1, 30)


@pytest.fixture
def impressions(spark):
    """Build interactions from dicts; what is not given is an ordinary local impression."""
    defaults = {
        "user_id": 1, "doc_id": "d1", "nr_zip": "z1", "pdate": DAY, "ts": 1, "channel_name": "local",
        "channel_id": "k122516", "nr_condition": "local_pop", "joined": 1, "checked": 1, "clicked": 0,
        "shared": 0, "thumbed_up": 0, "cv_time": 3000, "os": "ios",
        "doc_comment_cnt": 0, "doc_thumb_up_cnt": 0,
    }

    def build(*rows):
        names = list(defaults)
        data = [tuple({**defaults, **row}[n] for n in names) for row in rows]
        return spark.createDataFrame(data, schemas.INTERACTIONS)

    return build


@pytest.fixture
def documents(spark):
    from datetime import datetime

    def build(*rows):
        data = []
        for row in rows:
            first = row.get("first_cat", {})
            second = row.get("second_cat", {})
            data.append(
                (
                    row["doc_id"],
                    row.get("pdate", DAY),
                    row.get("publish_time", datetime(2024, 1, 30, 12)),
                    row.get("channels", []),
                    row.get("geotag", []),
                    (first, second),
                )
            )
        return spark.createDataFrame(data, schemas.DOC_DIM)

    return build


@pytest.fixture
def rows_of():
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
