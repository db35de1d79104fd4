"""Plans: feature recipes and end-to-end workflows composed from the operators."""
