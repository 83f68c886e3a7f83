"""retail_lens: retail sales analytics as lazy Spark DataFrame jobs."""

from retail_lens.functions.months import Period, PeriodSpec
from retail_lens.plans.model import Focus, Star
from retail_lens.session import Staging, get_spark

__all__ = ["Focus", "Period", "PeriodSpec", "Staging", "Star", "get_spark"]
