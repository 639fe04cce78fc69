"""DataFrame operators: DataFrame(s) + column names in, lazy DataFrame out."""
