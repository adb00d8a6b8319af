import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyroll.runtime import clear_staged, local_session

    session = local_session("tests", "8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def receipts(spark):
    """Prepared receipts where one user, merchant and coupon hold a third of the rows."""
    from pyspark.sql import functions as F

    from tallyroll.plans.dataset import prepare
    from tallyroll.runtime import stage
    from tallyroll.sources import receipts as load

    raw = load(spark, SF)
    hot = F.pmod(F.xxhash64(*raw.columns), F.lit(3)) == 0
    raw = raw.withColumn("_hot", hot)
    for column in ("User_id", "Merchant_id"):
        raw = raw.withColumn(column, F.when(F.col("_hot"), 1).otherwise(F.col(column)))
    raw = raw.withColumn("Coupon_id", F.when(F.col("_hot") & F.col("Coupon_id").isNotNull(), 1).otherwise(F.col("Coupon_id")))
    return stage(prepare(raw.drop("_hot")), "test-receipts")


@pytest.fixture(scope="session")
def frames(receipts):
    from tallyroll.operators.filters import split_windows

    return split_windows(receipts, receipts.limit(0).drop("Date", "use_day", "label"))["train"]
