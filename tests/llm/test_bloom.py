import numpy as np
import pytest

from branchwise.llm.bloom import LEAST_BITS, bloom, may_hold
from branchwise.llm.words import mix


@pytest.mark.parametrize("n", [0, 1, 200_000])
def test_holds_all_and_few_others(spark, n):
    h = mix(np.arange(1, 2 * n + 2, dtype=np.uint64))
    field = bloom(spark.createDataFrame([(int(x),) for x in h[:n].view(np.int64)], "h long"), "h")
    assert len(field) * 8 >= max(LEAST_BITS, 16 * n)
    assert may_hold(field, h[:n]).all()
    assert may_hold(field, h[n:]).mean() < 0.03
