"""Profile, split, encode, model and evaluate operators."""
