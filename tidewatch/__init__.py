"""Feature preparation, scoring and drift monitoring of tabular models on Spark DataFrames."""

from tidewatch.params import DEFAULT_SPEC, FeatureSpec, MonitorParams

__all__ = ["DEFAULT_SPEC", "FeatureSpec", "MonitorParams"]
