"""What the driver calls."""

import __spark_entry__ as entry
from plantflow import oracle, registry


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "machine_id" and df.count() == 15


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_operator_list_names_real_things():
    import importlib
    import os
    import re

    text = open(os.path.join(os.path.dirname(entry.__file__), "OPERATORS.md")).read()
    for module in set(re.findall(r"`((?:functions|operators|plans|sources|streaming)\.\w+)", text)):
        importlib.import_module(f"plantflow.{module}")
    for path, name in re.findall(r"`((?:functions|operators|plans|sources|streaming)\.\w+)\.(\w+)`", text):
        assert hasattr(importlib.import_module(f"plantflow.{path}"), name), (path, name)
    listed = set(re.findall(r"`(\w+)`", text))
    assert set(registry.queries()) <= listed
