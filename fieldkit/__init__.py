"""fieldkit: DataFrame operators for signals, sites, clusters and experiments."""
