"""kitwise: supply-coverage analytics over bills of materials, on Spark.

Stages are plain ``DataFrame -> DataFrame`` functions under
``kitwise.operators``; ``kitwise.plans`` wires them into the report job.
"""

from kitwise.params import LocationRule, ReportParams

__all__ = ["LocationRule", "ReportParams"]
