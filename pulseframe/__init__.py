"""Clinical vitals analytics on Spark: features, forests and streaming scores.

Every operator is a function from DataFrames to a DataFrame. The caller brings
the session; nothing here reads configuration files or keeps global state.
"""
