"""Elements with many properties."""

import time

from pyspark.sql import functions as F

from rowgraft.operators.properties import with_valid_keys


def test_many_properties_with_valid_names_are_not_compared_with_each_other(spark):
    """Before, each name was made valid again for each other name of its element: 20 s and more here."""
    wide = spark.range(40).select(F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.struct(F.concat(F.lit("p_"), i.cast("string")), F.concat(i, F.col("id")).cast("string")))).alias("props"))
    start = time.monotonic()
    assert {r.n for r in wide.select(F.size(with_valid_keys(F.col("props"))).alias("n")).collect()} == {400}
    assert time.monotonic() - start < 10
    odd = spark.sql("select map('a', '1', 'b c', '2', 'b_c', '3', '9', '4', 'd\\n', '5', 'none', cast(null as string)) as props")
    assert odd.select(with_valid_keys(F.col("props"))).first()[0] == {"a": "1", "b_c": "3", "k_9": "4", "d_": "5"}
