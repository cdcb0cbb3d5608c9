"""Times and row readers that several test modules share."""

from datetime import datetime

T0 = datetime(2024, 5, 1, 12, 0)
T1 = datetime(2024, 5, 1, 12, 5)
T2 = datetime(2024, 5, 1, 12, 9)
AS_OF = datetime(2025, 1, 1)


def rows(df):
    return [tuple(r) for r in df.collect()]


def row_set(df):
    out = [tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)
