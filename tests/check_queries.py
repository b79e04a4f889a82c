"""Compare every registered query with its SQL: python tests/check_queries.py [sf_dir] [name ...]"""

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(plain(r[n]) for n in names) for r in df.collect()]


def duck_rows(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, [tuple(plain(r[i]) for i in at) for r in cursor.fetchall()], types


def difference(spark_result, duck_result):
    (a_names, a), (b_names, b) = spark_result, duck_result[:2]
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a, b = sorted(a, key=key), sorted(b, key=key)
    if len(a) != len(b):
        extra = sorted(set(a) - set(b), key=key)[:3], sorted(set(b) - set(a), key=key)[:3]
        return f"{len(a)} rows != {len(b)}; only here {extra[0]}; only there {extra[1]}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {dict(zip(a_names, x))} != {y}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from sluiceway.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    oracle = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        df = query(spark, sf)
        got = spark_rows(df)
        took = time.time() - began
        if name not in oracle:
            print(f"rows {name}: {len(got[1])} ({took:.1f}s)", flush=True)
            continue
        duck = duck_rows(sf, oracle[name])
        why = difference(got, duck)
        kinds = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "StringType()": "VARCHAR",
                 "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN"}
        off = [(f.name, str(f.dataType), duck[2].get(f.name)) for f in df.schema.fields
               if kinds.get(str(f.dataType)) != duck[2].get(f.name)]
        bad += bool(why)
        print(f"{'FAIL' if why else 'ok'} {name}: {len(got[1])} rows ({took:.1f}s)"
              f"{' ' + why if why else ''}{' types ' + str(off) if off else ''}", flush=True)
    sys.exit(bool(bad))
