"""Plans: staging models, marts, served queries, the pipeline and the query
catalog used by the entry points and the benchmark."""
