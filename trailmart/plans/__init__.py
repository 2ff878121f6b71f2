"""The batch stages, the query catalog and its SQL oracles."""
