"""The streaming job produces the same features as the batch plan."""

import tempfile

from pyspark.sql import functions as F

from wafercast.plans import wafer_queries as W
from wafercast.sources.wafers import raw_wafers
from wafercast.streaming.features_stream import raw_wafer_stream, start_feature_stream

from .conftest import SMALL


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="wafercast-stream-")
    raw = raw_wafers(spark, SMALL).drop("h", "w")
    raw.write.mode("overwrite").parquet(f"{base}/in")
    q = start_feature_stream(spark, raw_wafer_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt",
                             available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(f"{base}/out").drop("batch_id")
    want = W.q_wafer_features(spark, SMALL)
    cols = [c for c in want.columns]
    g = got.select(*[F.round(c, 6).alias(c) if c not in ("wafer_id", "target") else F.col(c) for c in cols])
    assert g.count() == want.count()
    assert g.exceptAll(want.select(*cols)).count() == 0
