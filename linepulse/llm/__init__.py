"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_PLACES = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
if _ROOT not in map(os.path.realpath, filter(None, _PLACES)) and _ROOT not in _PLACES:
    # Workers can't import the package from their path: its functions travel with the tasks.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
