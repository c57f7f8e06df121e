"""Silver, Gold, reporting and observation operators: DataFrame(s) in, DataFrame out."""
