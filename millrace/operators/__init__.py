"""DataFrame in, DataFrame out: the data-processing steps."""
