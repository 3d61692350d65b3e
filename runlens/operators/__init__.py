"""Quality-control operators, one module per kind of input."""
