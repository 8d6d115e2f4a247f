import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from estatescope.session import get_spark

    session = get_spark(
        "tests",
        **{
            "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def empty_sf(spark, tmp_path_factory):
    """The test tables without rows."""
    folder = tmp_path_factory.mktemp("empty")
    for name in os.listdir(SF):
        spark.read.parquet(f"{SF}/{name}").limit(0).write.parquet(str(folder / name))
    return str(folder)


@pytest.fixture(scope="session")
def null_sf(spark, tmp_path_factory):
    """The test tables with a few real rows, each given twice, and rows of nothing but nulls; extra columns with
    names that operators use inside."""
    from pyspark.sql import functions as F

    folder = tmp_path_factory.mktemp("nulls")
    for name in os.listdir(SF):
        df = spark.read.parquet(f"{SF}/{name}").limit(40)
        nothing = spark.range(3).select(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])
        out = df.unionByName(df).unionByName(nothing)
        for extra in ("rep", "n", "rank", "group", "token", "word", "value", "__key", "block"):
            if extra not in out.columns:
                out = out.withColumn(extra, F.lit("clash"))
        out.coalesce(1).write.parquet(str(folder / name))
    return str(folder)


def against_duckdb(spark, sf_dir, queries, sql, names):
    """Names whose Spark rows differ from DuckDB's."""
    import glob

    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(sf_dir + "/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    rows = lambda t: sorted(tuple(str(x) for x in r) for r in zip(*[t.column(c).to_pylist() for c in sorted(t.column_names)]))
    return [n for n in names if rows(queries[n](spark, sf_dir).toArrow()) != rows(con.sql(sql[n]).to_arrow_table())]
