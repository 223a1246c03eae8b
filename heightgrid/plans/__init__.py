"""The three end-to-end jobs: data set, training, mapping."""
