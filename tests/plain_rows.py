"""Rows of a result as plain values, for comparing."""


def as_dicts(df, *key):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: str([r[k] for k in key or sorted(r)]))
