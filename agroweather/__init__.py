"""Daily county weather and annual crop yields, modelled with Spark DataFrames."""
