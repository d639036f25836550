"""idloom: creator-identity tables built as Spark DataFrame pipelines.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``idloom.sources``   – raw source registry and the test-data adapters
* ``idloom.functions`` – column helpers (text cleaning, strict casts, keys)
* ``idloom.operators`` – staging specs, observation map, ownership timeline,
  creator spine, email dimension, external-id map, point-in-time lookup,
  data-quality checks
* ``idloom.plans``     – end-to-end build of the published tables and writers
"""

from idloom.config import PipelineConfig

__all__ = ["PipelineConfig"]
