"""Operators for preparing language-model training data, each by the method its module names."""
