"""A fast slice of the registered queries against their DuckDB SQL at sf0.001."""
import duckdb
import pytest

import __spark_entry__ as entry
from data_folders import SF_SMALL

NAMES = ["clean_trips", "station_hour_demand", "station_hour_lags", "station_hotspots", "flow_summary",
         "regression_metrics", "temporal_split", "scenario_feature_frame"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(df):
    import math
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(repr(None if (isinstance(v, float) and math.isnan(v)) else
                              (round(v, 6) if isinstance(v, float) else str(v))) for v in rec))
    return cols, sorted(out)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert _norm(got) == _norm(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
