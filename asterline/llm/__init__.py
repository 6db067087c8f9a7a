"""Operators of a training-data pipeline.

Functions that run inside tasks travel with the task, so executors need no copy of this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
