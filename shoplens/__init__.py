"""shoplens: e-commerce behaviour analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame(s) + TaskParams -> DataFrame``. Nothing
data-sized is collected to the driver; the only driver-side values are task
parameters and results that are bounded by construction (top-k tables).
"""

from shoplens.params import TaskParams

__all__ = ["TaskParams"]
