"""Marketplace listing analytics on Spark: profile, clean, describe and segment sellers."""
