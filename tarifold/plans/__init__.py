"""How work is laid out over the cluster, and the complete runs made of operators."""
