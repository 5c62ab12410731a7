"""Command line: python -m tests.compare [sf folder] [query names …]."""

import sys
import time

from tests.oracle import compare, connect
from tidemark.catalog import registered
from tidemark.session import build_session


def main(folder="/root/testdata/sf0.01", *names):
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, q in registered.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if q.sql is None:
                n, why = q.run(spark, folder).count(), "no SQL"
            else:
                n, why = compare(spark, con, folder, q.run, q.sql)
        except Exception as e:  # report and go on
            n, why = -1, f"{type(e).__name__}: {str(e)[:700]}"
        bad += why not in (None, "no SQL")
        print(f"{'ok  ' if why is None else '--  '} {name:28s} {n:8d} {time.time() - start:6.2f}s {why or ''}", flush=True)
    print("differing:", bad)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
