"""Domain tables and questions built from the operators."""
