"""Hidden Markov models over sequence tables."""
