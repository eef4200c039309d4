"""Model pipeline on DataFrames: splits, scaling, classifiers, evaluation, yearly predictions."""
