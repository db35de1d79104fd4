"""DataFrame operators: profiling, schema, group statistics, joins, set ops, ranking,
sampling, encoders, metrics, models, ensembles, search and explanation."""
