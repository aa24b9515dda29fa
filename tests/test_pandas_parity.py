"""Column helpers against pandas itself on many random values at once:
``pd.cut`` (both closures, include_lowest, the top edge), ``pd.to_numeric``
with ``errors='coerce'`` and Python's lower/strip/replace."""

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from metricforge.functions.binning import bucketize
from metricforge.functions.coerce import coerce_numeric
from metricforge.functions.text import normalize_text


def _same(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return a == b


def test_bucketize_matches_pd_cut(spark):
    rnd = random.Random(7)
    edges = [-1, 0, 3, 8, 10]
    labels = ["a", "b", "c", "d"]
    vals = [float(rnd.choice(edges)) if rnd.random() < 0.3 else round(rnd.uniform(-2, 11), 2) for _ in range(400)]
    vals += [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    s = pd.Series(vals, dtype="float64")
    for right, lowest in ((False, False), (False, True), (True, False), (True, True)):
        want = pd.cut(s, bins=edges, labels=labels, right=right, include_lowest=lowest).astype(object)
        got = [r["b"] for r in df.select("i", bucketize("v", edges, labels, right=right, include_lowest=lowest)
                                         .alias("b")).orderBy("i").collect()]
        for i, (g, w) in enumerate(zip(got, want)):
            w = None if (isinstance(w, float) and np.isnan(w)) else w
            assert g == w, (right, lowest, vals[i], g, w)


def test_coerce_numeric_matches_pandas(spark):
    texts = ["1", " 2 ", "3.5", "-4", "1e3", "tbd", "", " ", "nan", "NaN", "abc", "7.", ".5", "+8", "1,000"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["v"] for r in df.select("i", coerce_numeric("t").alias("v")).orderBy("i").collect()]
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce").tolist()
    for t, g, w in zip(texts, got, want):
        assert _same(g, w if not (isinstance(w, float) and math.isnan(w)) else None), (t, g, w)


def test_text_normalisation_matches_python(spark):
    rnd = random.Random(3)
    alphabet = list("abcXYZ éÉüÜßçÇ") + ["\t", "\n", "\u00a0", "\u2003", "\x1c", "  ", "   "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["n"] for r in df.select("i", normalize_text("t").alias("n")).orderBy("i").collect()]
    want = [t.lower().strip().replace("  ", " ") for t in texts]
    assert got == want
