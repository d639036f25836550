"""DataFrame -> DataFrame operators of the identity pipeline."""
