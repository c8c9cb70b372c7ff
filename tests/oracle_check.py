"""Run every registered query in Spark and its oracle SQL in DuckDB and
compare row count, column names/type families and the multiset of values.

    python tests/oracle_check.py [sf_dir] [name ...]

Environment overrides: ORACLE_TZ, ORACLE_SHUFFLE_PARTITIONS, ORACLE_AQE, ORACLE_ANSI.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import warnings

warnings.filterwarnings("ignore")

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from strata.plans.tables import TABLES  # noqa: E402


def _canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    if isinstance(v, bool):
        return bool(v)
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_canon(x) for x in rec))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


_SPARK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
          "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _type_mismatch(schema, dtypes):
    bad = []
    for f in schema.fields:
        st = f.dataType.simpleString()
        want = _SPARK.get(st, st.upper())
        got = dtypes.get(f.name, "?")
        if want != got and not (st.startswith("decimal") and got.startswith("DECIMAL")):
            bad.append(f"{f.name}:{st}/{got}")
    return ",".join(bad)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from strata.session import local_session
    spark = local_session()
    # optional session overrides, to check that results do not depend on
    # the caller's session (time zone, shuffle partitions, AQE)
    for env, key in (("ORACLE_TZ", "spark.sql.session.timeZone"),
                     ("ORACLE_SHUFFLE_PARTITIONS", "spark.sql.shuffle.partitions"),
                     ("ORACLE_AQE", "spark.sql.adaptive.enabled"),
                     ("ORACLE_ANSI", "spark.sql.ansi.enabled")):
        if os.environ.get(env):
            spark.conf.set(key, os.environ[env])
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows-only {name}: {len(spdf)} rows  ({ts:.1f}s)")
            continue
        try:
            dpdf = con.execute(sqls[name]).to_arrow_table().to_pandas()
            dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({sqls[name]})").fetchall()}
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = _rows(spdf)
        dc, dr = _rows(dpdf)
        if sc != dc:
            print(f"FAIL {name}: columns differ\n  spark={sc}\n  duck ={dc}")
            bad += 1
            continue
        if len(sr) != len(dr):
            print(f"FAIL {name}: rows spark={len(sr)} duck={len(dr)}")
            bad += 1
            continue
        if sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
            continue
        warn = _type_mismatch(sdf.schema, dtypes)
        print(f"ok   {name}: {len(sr)} rows  ({ts:.1f}s){'  TYPES ' + warn if warn else ''}")
    print("FAILED:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
