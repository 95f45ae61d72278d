"""The three whole-table jobs: preprocess, generate, postprocess."""
