"""Helpers that tests import; fixtures are in conftest.py."""


def rows(df):
    return [tuple(r) for r in df.collect()]
