"""Outlier detection for very large collections of metric series, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from seriesguard.frame import SeriesFrame, series_frame
from seriesguard.plans.pipeline import analyze, run_detection
from seriesguard.plans.registry import detect

# Task functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["SeriesFrame", "analyze", "detect", "run_detection", "series_frame"]
