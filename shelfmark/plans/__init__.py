"""Jobs made of the operators: ETL, training, scoring, profiling."""
