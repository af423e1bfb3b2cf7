"""Transforms from DataFrame to DataFrame, the same in batch and in a stream unless they say otherwise."""
