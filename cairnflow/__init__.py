"""cairnflow: operational analytics and text-corpus processing on Spark DataFrames."""
