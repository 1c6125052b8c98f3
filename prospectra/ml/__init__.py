"""Feature stages and models as `pyspark.ml` estimators."""
