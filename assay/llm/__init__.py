"""Operators for preparing training data; every module holds one operator and its query.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""

import sys
from collections.abc import Callable
from importlib import import_module

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Functions of this package travel with the tasks, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODULES = (
    "token_counts",
    "html_wrappers",
    "sharding",
    "mixing",
    "warc",
    "decontaminate",
    "line_dedup",
    "vector_tree",
    "near_dedup",
    "toxicity",
    "bpe_codec",
    "collocations",
    "conversation_repair",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for name in MODULES:
        found |= import_module(f"assay.llm.{name}").QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found = {}
    for name in MODULES:
        found |= getattr(import_module(f"assay.llm.{name}"), "SQL", {})
    return found
