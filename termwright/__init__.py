"""Record matching, evidence retrieval and audit over Spark DataFrames."""
