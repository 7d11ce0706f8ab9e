"""Run a registered query in Spark and its SQL in DuckDB, and compare the two bags of rows."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def compare(spark, sf_dir, query, sql) -> str | None:
    """None if equal, else what differs."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    ours = Counter(tuple(_plain(v) for v in row) for row in frame.select(*[f"`{n}`" for n in names]).collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = con.execute(sql)
    held = [d[0] for d in result.description]
    if sorted(held) != names:
        return f"columns {names} != {sorted(held)}"
    order = [held.index(n) for n in names]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} vs {sum(theirs.values())}; only spark {sum(only_ours.values())} "
        f"{list(only_ours)[:2]}; only sql {sum(only_theirs.values())} {list(only_theirs)[:2]}"
    )


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from tidegate.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    session = local_session(8)
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            if name in sqls:
                verdict = compare(session, sf, query, sqls[name]) or "ok"
            else:
                verdict = f"rows only: {query(session, sf).count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {str(error)[:600]}"
        print(f"{name:28s} {time.time() - begun:6.1f}s  {verdict}", flush=True)
