"""Security-event analytics on Spark: readers, features, detectors, queries and stream jobs."""

import sys

from pyspark import cloudpickle

from sentrylake.session import build_session, prepare, scratch_path

# Code that runs in tasks travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "prepare", "scratch_path"]
