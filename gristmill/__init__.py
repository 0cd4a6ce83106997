"""gristmill: curating, verifying and analysing training data with PySpark DataFrames."""
