"""Whole analyses built from the operators: configurations, training and scoring, model search, the query catalogue."""
