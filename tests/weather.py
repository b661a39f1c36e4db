"""Small daily tables."""

from datetime import date, timedelta

FIRST = date(2020, 1, 1)


def series(spark, cell=1, start=FIRST, **values):
    n = len(next(iter(values.values())))
    rows = [(cell, start + timedelta(days=i), *(None if v[i] is None else float(v[i]) for v in values.values())) for i in range(n)]
    return spark.createDataFrame(rows, "cell_id long, date date, " + ", ".join(f"{k} double" for k in values))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()
