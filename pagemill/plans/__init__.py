"""Jobs composed from the operators: the feature job and the published corpus table."""
