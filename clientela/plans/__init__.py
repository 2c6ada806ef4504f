"""Monthly jobs composed from the operators."""
