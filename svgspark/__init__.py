"""svgspark: SVG corpus mining, normalisation and training-set preparation as Spark jobs.

Sub-packages:
  sources    scans, fixture views over the driver tables, sinks
  functions  column expressions (hashing, text clean-up, URL, style maps)
  operators  DataFrame -> DataFrame jobs (selection, mining, tree, geometry, clean-up, captions, training)
  plans      composed jobs and the query/oracle registry
  streaming  Structured Streaming forms of the mining jobs
"""

from svgspark.session import get_spark, scratch_dir  # noqa: F401
