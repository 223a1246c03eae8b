"""Gridded height data from point clouds and pixel embeddings, as Spark DataFrame jobs."""
