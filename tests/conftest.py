from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adspark.session import CONF  # noqa: E402
from adspark.stage import CHECKPOINT_CONF, drop_stages  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]").appName("adspark-tests")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.maxMetadataStringLength", "2000"))
    for key, value in CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    if not session.conf.get(CHECKPOINT_CONF, None):
        session.stop()
        session = builder.config(CHECKPOINT_CONF, str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_stages(session)
    session.stop()


@pytest.fixture
def make(spark):
    """``make("a long, t timestamp_ntz", (1, "2024-01-01 00:00:00"))``: rows, cast to a schema."""

    def build(ddl: str, *rows):
        from pyspark.sql import functions as F
        names = [c.strip().split(" ")[0] for c in ddl.split(",")]
        types = [c.strip().split(" ", 1)[1] for c in ddl.split(",")]
        raw = [tuple(str(v) if isinstance(v, bool) or (v is not None and not isinstance(v, list)) else v for v in r)
               for r in rows]
        text = ", ".join(f"{n} {t if t.startswith('array') else 'string'}" for n, t in zip(names, types))
        df = spark.createDataFrame(raw, text)
        return df.select(*[F.col(n).cast(t).alias(n) for n, t in zip(names, types)])

    return build
