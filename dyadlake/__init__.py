"""dyadlake: a Spark-first engine for building, auditing and scoring large sets of paired structures."""
