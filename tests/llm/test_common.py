import pytest

from funnelwright.llm.common import BATCH_BYTES, small_batches

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("own, inside", [("64m", str(BATCH_BYTES)), ("1g", str(BATCH_BYTES)), ("1024", "1024"), ("4m", "4m"), ("100KB", "100KB")])
def test_small_batches_hold_for_the_block_only(spark, own, inside):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, own)
    try:
        outside = spark.conf.get(LIMIT)
        with pytest.raises(ZeroDivisionError), small_batches(spark):
            assert spark.conf.get(LIMIT) == inside
            raise ZeroDivisionError
        assert spark.conf.get(LIMIT) == outside
    finally:
        spark.conf.set(LIMIT, before)
