"""tessera: platform-telemetry analytics as composable PySpark DataFrame functions.

Every public function builds a lazy DataFrame plan (``fn(df, ...) -> df``) or a
``Column`` expression; Catalyst, AQE and Structured Streaming do the execution.
"""

__version__ = "0.1.0"
