"""Comparing frames and reading plans."""

import math
import random
from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def rows(df, digits=9):
    """Rows as sorted tuples, columns by name, floats rounded."""

    def tidy(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, digits) + 0.0
        return v

    cols = sorted(df.columns)
    found = [tuple(tidy(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=400, seed=7, parts=5):
    """A third of the rows under key 'hot', some under NULL, every fifth value missing."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "a", "b", "c", None])
        value = None if rng.random() < 0.2 else round(rng.uniform(0, 20), 1)
        ts = START + timedelta(seconds=rng.randrange(50_000), microseconds=i)
        data.append((i, key, ts, value))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id bigint, k string, ts timestamp_ntz, v double").repartition(parts)
