"""keelson: a PySpark-native query library.

Revenue per customer region (``keelson.plans``) and, as an optional
subpackage, operators for large training corpora (``keelson.llm``).
Everything runs on Spark; Catalyst and AQE choose the physical plan.
"""

__version__ = "0.2.0"
