"""School tables and landed pages made from the driver's test tables, for queries, tests and the benchmark."""
