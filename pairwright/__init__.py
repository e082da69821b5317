"""Record linkage on Spark: normalise, block, compare, cluster, evaluate, profile."""
