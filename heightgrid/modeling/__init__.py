"""Regressors, search and evaluation on spatial folds with Spark ML."""
