"""Part of citeloom; see the README for the map of modules."""
