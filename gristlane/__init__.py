"""gristlane: a PySpark-native engine for curation, decision analytics and corpus preparation.

``operators`` holds DataFrame -> DataFrame operators, ``functions`` column expressions,
``sources`` readers and sinks, ``plans`` whole queries over the driver tables and
``streaming`` the Structured Streaming forms.  ``llm`` is optional and nothing here imports it.

Functions that run on executors are pickled by value: workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
