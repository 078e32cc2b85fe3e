"""Site rules and the whole-pipeline plans built from the operators."""
