"""Metatranscriptomics and RNA-seq tables on Spark: DataFrame in, DataFrame out."""
