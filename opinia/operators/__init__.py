"""DataFrame-level operators: terms and vocabularies, exploration, scaling, selection, classifiers, evaluation."""
