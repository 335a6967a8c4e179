"""Operators for large training-data corpora; nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
