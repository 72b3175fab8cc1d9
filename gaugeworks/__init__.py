"""gaugeworks: sensor-telemetry analytics as Spark DataFrame operators.

Readings arrive as keyed JSON envelopes (Kafka or files), are flattened
into typed wide rows with an event time, and feed tumbling-window
analyses (statistics, range anomalies, health scores), latest values,
control-action detection and time-series point sinks.  Every operator is
a ``DataFrame -> DataFrame`` function driven by a ``PipelineSpec`` and
runs the same on batch tables and Structured Streaming.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from .spec import EVENTS, HYDROPONIC, LINEITEM, PipelineSpec, SensorSpec

# Ship this package's code by value inside the Python functions Spark sends
# to its workers (mapInPandas / applyInPandasWithState closures), so
# executors need no installed copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["EVENTS", "HYDROPONIC", "LINEITEM", "PipelineSpec", "SensorSpec"]
