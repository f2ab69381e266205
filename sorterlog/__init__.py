"""Spark analytics for parcel-sorter controller logs and alarm histories."""
