import datetime as dt
import math
from collections import Counter


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return sorted(df.columns), bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return sorted(cols), bag(cols, res.fetchall())
