"""Source tables: schemas, the star-schema adapter and the name registry."""

from shelfcost.sources.catalog import Sources, from_frames, from_star, from_tables

__all__ = ["Sources", "from_frames", "from_star", "from_tables"]
