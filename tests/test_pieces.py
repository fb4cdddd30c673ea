"""What a model is given at a time."""

import pandas as pd

from talkmill.sources import readers


def test_a_model_gets_rows_in_pieces(spark):
    sizes = readers.with_model(spark.range(0, 3000, 1, 1), lambda x: pd.Series([len(x)] * len(x)), "id", "n", "int", at_once=100)
    assert {r["n"] for r in sizes.select("n").collect()} == {100}
