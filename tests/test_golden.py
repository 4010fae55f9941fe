"""Golden facts: SURVEY §7 minimum-slice counts and the recorded 15,000-row split."""

import pytest
from pyspark.sql import functions as F

# windows and flags per split (train, val, test) recorded in SURVEY §7 for the minimum slice
GOLDEN = {"/root/testdata/sf0.001": ((2191, 475, 617), (143, 4, 40)),
          "/root/testdata/sf0.01": ((2210, 480, 625), (166, 5, 47))}


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_minimum_slice_counts(spark, sf):
    import __spark_entry__ as E
    df = E.queries()["minimum_slice"](spark, sf)
    r = {x.split: (x.n, x.f) for x in df.groupBy("split").agg(F.count("*").alias("n"),
                                                             F.sum("flag").alias("f")).collect()}
    wins, flags = GOLDEN[sf]
    assert tuple(r[s][0] for s in ("train", "val", "test")) == wins
    assert tuple(r[s][1] for s in ("train", "val", "test")) == flags
