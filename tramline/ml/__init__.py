"""Arrival-delay features, examples, training and scoring."""
