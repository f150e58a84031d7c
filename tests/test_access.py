from pyspark.sql import functions as F

from strata import config as C
from strata.operators.chunks import with_tier
from strata.plans.access_q import clearance_df


def test_tier_monotonicity_and_unknown_user(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(30)], "doc_id long, text string")
    vis = with_tier(docs).join(F.broadcast(clearance_df(spark)), "level")
    seen = {u: {r.doc_id for r in vis.where(F.col("user_level") == u).collect()} for u in C.CLEARANCE}
    assert seen["general"] < seen["level_q"] < seen["admin"]
    assert len(seen["admin"]) == 30
    unknown = with_tier(docs).join(clearance_df(spark).where("user_level = 'nobody'"), "level")
    assert unknown.count() == 0
