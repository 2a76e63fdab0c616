"""The feature plans: pure functions from source DataFrames and ``Params`` to DataFrames."""
