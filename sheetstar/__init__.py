"""Versioned company snapshots on Spark: worksheets in, star schema and queries out."""
