"""Event shards and the list of them."""
