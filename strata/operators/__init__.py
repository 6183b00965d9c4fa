"""Operators over DataFrames: trips, link statistics, text features, kNN, logistic regression."""

from strata.operators import common, knn, links, logreg, text, trips

__all__ = ["common", "trips", "links", "text", "knn", "logreg"]
