"""Learned field detection: features, labels, training, scoring, thresholds, evaluation."""
