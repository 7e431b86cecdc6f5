"""Catalog snapshots derived from the driver's tables, and the queries registered over them."""
