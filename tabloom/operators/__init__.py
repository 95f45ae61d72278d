"""Fitted column transforms, generation from dense weights and evaluation metrics."""
