"""The stand-in for a text encoder."""

import pandas as pd

from talkmill.sources import readers


def test_words_that_cancel_each_other_out_have_a_vector():
    encode = readers.hashed_encoder(1)
    words = [f"w{i}" for i in range(40)]
    sign = {w: v[0] for w, v in zip(words, encode(pd.Series(words)))}
    pair = f"{next(w for w in words if sign[w] > 0)} {next(w for w in words if sign[w] < 0)}"
    assert [abs(v[0]) for v in encode(pd.Series([pair, pair, " ", None]))] == [1.0, 1.0, 0.0, 0.0]
