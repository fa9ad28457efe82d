"""Table contracts, readers, writers and the star-schema mapping."""
