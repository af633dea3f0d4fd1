"""The timed Python restatement gives what the job gives."""

from __future__ import annotations

from suite.baseline import cooccur_daily_in_python
from suite.queries import QUERIES


def test_python_functions_give_the_same_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    plain = cooccur_daily_in_python(spark, sf_dir)
    native = QUERIES["cooccur_daily"](spark, sf_dir)
    assert plain.exceptAll(native).count() == native.exceptAll(plain).count() == 0
    assert native.count() > 0
