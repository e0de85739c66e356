"""Tabular analytics and machine learning as Spark jobs."""

import importlib
import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PUBLIC = ("gramspan.sources", "gramspan.operators")


def __getattr__(name: str):
    """``from gramspan import KMeans`` and the like, loaded on first use."""
    for module in map(importlib.import_module, _PUBLIC):
        if name in module.__all__:
            return getattr(module, name)
    raise AttributeError(f"module 'gramspan' has no attribute {name!r}")
