import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import rows_of  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def compare(spark, con, name, sf_dir):
    df = E.queries()[name](spark, sf_dir)
    s = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d = rows_of([x[0] for x in res.description], res.fetchall())
    return s == d
