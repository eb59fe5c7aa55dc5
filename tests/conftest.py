import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shopvitals.session import pin_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin_session(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows as a frame: rows([(1, "a")], "id bigint, name string"); timestamps as text."""

    def build(values, schema):
        from pyspark.sql import functions as F
        from pyspark.sql import types as T

        wanted = T._parse_datatype_string(schema)
        as_text = T.StructType(
            [
                T.StructField(f.name, T.StringType() if _from_text(f.dataType) else f.dataType)
                for f in wanted
            ]
        )
        frame = spark.createDataFrame([tuple(v) for v in values], as_text)
        return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])

    return build


def _from_text(data_type):
    from pyspark.sql import types as T

    return isinstance(data_type, (T.TimestampType, T.DateType, T.DecimalType))
