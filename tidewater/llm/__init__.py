"""Operators of a training-data pipeline: tokenizing, fingerprints, near-duplicate and
repeat removal, classifiers, chat rendering, mixing.  Nothing else in the library
imports this subpackage."""
