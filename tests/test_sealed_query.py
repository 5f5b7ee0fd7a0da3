"""The sealed read covers the log up to its real ends."""

import pytest

from aerolith.operators import store
from aerolith.plans import queries

SF = "/root/testdata/sf0.01"


def test_gap_past_the_first_thousand_offsets_is_found(spark, monkeypatch):
    whole = queries.log
    assert queries.QUERIES["s5_sealed_read"](spark, SF).count() > 0
    last = whole(spark, SF).agg({"offset": "max"}).first()[0]
    assert last > 1200
    monkeypatch.setattr(queries, "log", lambda s, d: whole(s, d).filter("offset <> 1100"))
    with pytest.raises(store.IncompleteStream):
        queries.QUERIES["s5_sealed_read"](spark, SF)
