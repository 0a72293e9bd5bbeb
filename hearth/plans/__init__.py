"""Jobs built from the operators, and the operator catalog over the driver tables."""
