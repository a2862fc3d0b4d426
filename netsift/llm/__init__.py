"""Operators for training data: text in, decisions and statistics per document out."""
