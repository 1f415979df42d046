"""Well-cost analytics and cost-per-foot regression as Spark DataFrame and MLlib jobs."""

__version__ = "0.1.0"
