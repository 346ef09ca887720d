"""Raw feeds, reference bundles and contract tables as DataFrames."""
