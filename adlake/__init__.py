"""adlake: an advertising-impressions lakehouse built on Spark DataFrames.

Bronze (strict strings + provenance) -> Silver (typed) -> Gold (daily reports),
with data-quality checks, exact table comparison, interchangeable physical
options and Spark jobs over event logs that prove what ran.
"""
from adlake.model import Options

__all__ = ["Options"]
