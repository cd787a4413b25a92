"""User-level verbs made of the operators."""
