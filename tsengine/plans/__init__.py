"""Feature, live, serving and experiment plans composed from the operators."""
