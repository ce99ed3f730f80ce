"""DNA-methylation coverage analytics on Spark DataFrames."""
