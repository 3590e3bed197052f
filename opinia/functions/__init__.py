"""Column-level building blocks: fixed word and symbol data, tokenising, n-grams, stemming rules."""
