"""trustlens: review-trust analytics on Spark DataFrames."""
