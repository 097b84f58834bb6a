"""Compare the column types of each Spark query with its DuckDB oracle (sf0.001)."""
import sys
sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
import duckdb
from marquee.plans.catalog import ORACLES, QUERIES, load_all
from marquee.session import local_session
from marquee.sources.fixtures import TABLES
load_all()
spark = local_session(8)
sf = "/root/testdata/sf0.001"
con = duckdb.connect()
for t in TABLES:
    con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
M = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
     "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT"}
for name in sorted(ORACLES):
    df = QUERIES[name](spark, sf)
    st = {f.name: M.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    res = con.execute(f"select * from ({ORACLES[name]}) limit 0")
    dt = {d[0]: str(d[1]) for d in res.description}
    bad = [(c, st.get(c), dt.get(c)) for c in st if st.get(c) != dt.get(c)]
    if bad:
        print(name, bad)
