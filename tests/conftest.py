import pytest

from sparkhunt.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def text_of(spark):
    """Evaluate a column function on a list of texts."""

    def run(fn, texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        out = rows.select("i", fn(F.col("t")).alias("o")).collect()
        return [r["o"] for r in sorted(out, key=lambda r: r["i"])]

    return run
