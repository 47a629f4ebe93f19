import numpy as np
from pyspark.sql import functions as F

from mixlab.llm import bitmaps


def test_no_member_is_missed(spark):
    held = spark.range(5000).select((F.xxhash64("id")).alias("h"))
    rows = bitmaps.bitmap(held, F.col("h"))
    values = np.array([r["h"] for r in held.collect()])
    packed = bitmaps.to_array(rows)
    assert bitmaps.contains(packed, values).all()
    marked = bitmaps.mark(held, F.col("h"), rows, "m")
    assert marked.columns == ["h", "m"] and marked.where("m").count() == 5000
    other = spark.range(5000, 10000).select((F.xxhash64("id")).alias("h"))
    strangers = np.array([r["h"] for r in other.collect()])
    assert bitmaps.contains(packed, strangers).sum() == bitmaps.mark(other, F.col("h"), rows, "m").where("m").count() < 50
    edge = spark.createDataFrame([(0,), (-1,), (32767,), (32768,)], "h long")
    assert bitmaps.contains(bitmaps.to_array(bitmaps.bitmap(edge, F.col("h"))), np.array([0, -1, 32767, 32768, 1])).tolist() == [True] * 4 + [False]
    assert not bitmaps.contains(bitmaps.to_array(bitmaps.bitmap(edge.limit(0), F.col("h"))), np.array([0])).any()
