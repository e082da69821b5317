"""Complete linkage pipelines and the registered query catalogue."""
